"""Personal data by weak supervision, in DataFrame functions only.

Patterns propose spans (four strict kinds, and looser forms of e-mail, card and phone). Four
labelers vote on each: the strict pattern, a gazetteer (top-level domains, address ranges,
card issuers, country codes), the words around it, and its edges. Expectation-maximisation
over the counts of vote patterns estimates each labeler's reliability for each kind; the
posteriors train a logistic span classifier on votes, kind and shape. Its verdict adds spans
to the strict ones, which always stay.

Every text is searched whole, in its own row: matches and the text between them give code
point positions, summed in blocks so that a text with very many matches stays near linear.
What the driver gets is one row for each combination of kind, votes and shape (a fixed
number of combinations, however many documents there are).

Defined cases: a null or empty text has no spans; repeated rows are searched row by row; an
empty table gives an empty result; spans of one kind never overlap, spans of two kinds may.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

KINDS = ("email", "ip", "card", "phone")
VOTES = ("pattern", "gazetteer", "context", "edges")
#: Places per block of the position sums.
STEP = 256
LEFT, RIGHT = 32, 16

# Strict patterns as the contract has them. \G lets a match begin right after the last one;
# otherwise a match begins where its run of characters does, which keeps long runs linear
# (possessive groups do the same and change no match: nothing follows that they could give back).
_LOCAL = r"[A-Za-z0-9._%+-]"
_EMAIL = rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
_IP = r"(?:\G|(?<![0-9]))[0-9]++(?:\.[0-9]++){3}"
_CARD = r"[0-9](?:[\x20-]?[0-9])++"
_PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
# Looser forms, proposed to the classifier.
_EMAIL_SPELLED = rf"(?i)(?:\G|(?<!{_LOCAL})){_LOCAL}++ ?[\[(]at[\])] ?[A-Za-z0-9-]++(?: ?(?:\.|[\[(]dot[\])]) ?[A-Za-z0-9-]++)++"
_CARD_ALONE = r"(?<![0-9])(?:(?:[0-9]{4}[\x20-]){3}[0-9]{4}|[0-9]{13,19})(?![0-9])"
_PHONE_LOCAL = r"(?<![0-9A-Za-z+.-])(?:\([0-9]{3}\) ?|[0-9]{3}[-. ])[0-9]{3}[-. ][0-9]{4}(?![0-9A-Za-z-])"

#: (family, kind, pattern, what a text must hold to be searched, whether it is strict)
FAMILIES = (
    ("email", 0, _EMAIL, "@", True),
    ("ip", 1, _IP, r"[0-9]\.[0-9]", True),
    ("card", 2, _CARD, r"[0-9](?:[\x20-]?[0-9]){12}", True),
    ("phone", 3, _PHONE, r"\+[0-9]", True),
    ("card2", 2, _CARD_ALONE, r"[0-9](?:[\x20-]?[0-9]){12}", False),
    ("email2", 0, _EMAIL_SPELLED, r"(?i)[\[(]at[\])]", False),
    ("phone2", 3, _PHONE_LOCAL, r"[0-9]{3}[-. ][0-9]{4}", False),
)

#: Gazetteers: common top-level domains; country calling codes.
DOMAINS = ("com", "org", "net", "edu", "gov", "mil", "int", "info", "biz", "io", "co", "ai", "app", "dev", "eu", "us", "uk", "de", "fr",
           "es", "it", "nl", "be", "ch", "at", "se", "no", "dk", "fi", "pl", "pt", "ie", "cz", "gr", "ru", "ua", "tr", "cn", "jp", "kr", "in",
           "au", "nz", "ca", "mx", "br", "ar", "cl", "za", "local", "example", "test")
COUNTRY_CODES = r"^\+(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"
#: Words that speak for a kind or against it, in the text right before a span.
CUES = (
    r"(?i)(?:e-?mail|mail|contact|write|reach|correo|courriel|kontakt)\W{0,4}\w{0,8}\W{0,3}$",
    r"(?i)(?:\bip\b|address|server|host|client|from|adresse|direcci[oó]n)\W{0,4}\w{0,8}\W{0,3}$",
    r"(?i)(?:card|visa|master|amex|credit|karte|tarjeta|carte|payment)\W{0,4}\w{0,8}\W{0,3}$",
    r"(?i)(?:phone|tel|call|fax|mobile|cell|telefon|tel[eé]fono|t[eé]l)\W{0,4}\w{0,8}\W{0,3}$",
)
AGAINST = r"(?i)(?:version|\bv|release|isbn|issn|doi|order|invoice|serial|\bno|\bnr|#|\bid|page|build)\W{0,3}$"


def luhn(digits: Column) -> Column:
    """Whether a string of digits passes the Luhn check."""
    backwards = F.reverse(digits)

    def add(acc, i):
        v = F.substring(backwards, i, F.lit(1)).cast("int")
        twice = 2 * v
        return acc + F.when(i % 2 == 1, v).when(twice > 9, twice - 9).otherwise(twice)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _holds(kind: int, m: Column) -> Column:
    """The strict kind's condition on a match."""
    if kind == 0:
        return F.lit(True)
    if kind == 1:
        return F.forall(F.split(m, r"\."), lambda p: F.length(F.regexp_replace(p, "^0+", "")) <= 3) & F.forall(
            F.split(m, r"\."), lambda p: F.coalesce(F.right(p, F.lit(3)).cast("int"), F.lit(999)) <= 255)
    d = _digits(m)
    if kind == 2:
        return F.when(F.length(d).between(13, 19), luhn(d)).otherwise(F.lit(False))
    return F.length(d).between(9, 15)


def _gazetteer(kind: int, m: Column) -> Column:
    if kind == 0:
        return F.lower(F.regexp_extract(m, r"([A-Za-z0-9-]+)$", 1)).isin(*DOMAINS)
    if kind == 1:
        return ~m.rlike(r"^(?:0|22[4-9]|2[3-9][0-9])\.") & ~m.rlike(r"(?:^|\.)0[0-9]")
    if kind == 2:
        return _digits(m).rlike(r"^(?:4|5[1-5]|2[2-7]|3[47]|3[068]|6011|64|65|62)")
    return m.rlike(COUNTRY_CODES) | m.rlike(r"^\(?[2-9][0-9]{2}\)?")


def _shape(kind: int, m: Column) -> Column:
    """A few coarse forms of a span (0 to 3), as a feature."""
    if kind == 0:
        return F.when(m.contains("@"), F.least(F.lit(2), F.length(F.regexp_replace(m, r"[^.]", "")))).otherwise(F.lit(3))
    if kind == 1:
        return F.when(F.length(m) >= 11, F.lit(1)).otherwise(F.lit(0))
    if kind == 2:
        return F.when(m.rlike(r"[\x20-]"), F.lit(2)).otherwise(F.lit(0)) + F.when(F.length(_digits(m)) == 16, F.lit(1)).otherwise(F.lit(0))
    return F.when(m.startswith("+"), F.lit(2)).otherwise(F.lit(0)) + F.when(m.contains("("), F.lit(1)).otherwise(F.lit(0))


def _vote(yes: Column, no: Column) -> Column:
    """1 for, 2 against, 0 no opinion."""
    return F.when(yes, F.lit(1)).when(no, F.lit(2)).otherwise(F.lit(0))


def _span(family: tuple, x: Column, start: Column) -> Column:
    _, kind, _, _, strict = family
    m, left, right = x["m"], x["left"], x["right"]
    holds = _holds(kind, m)
    gazetteer = _gazetteer(kind, m)
    edge = left.rlike(r"[\p{L}\p{N}_@/=-]$") | right.rlike(r"^(?:[\p{L}\p{N}_@/-]|[.][0-9])")
    return F.struct(
        F.lit(kind).alias("kind"), start.alias("start"), (start + F.length(m)).alias("end"), (F.lit(strict) & holds).alias("base"),
        # The looser e-mail and phone patterns say nothing; a card number stands alone or not, but has its check digit.
        (_vote(holds, ~holds) if strict or kind == 2 else F.lit(0)).alias("pattern"),
        _vote(gazetteer, ~gazetteer).alias("gazetteer"),
        _vote(left.rlike(CUES[kind]), left.rlike(AGAINST)).alias("context"),
        _vote(~edge, edge).alias("edges"),
        _shape(kind, m).alias("shape"))


def _placed(family: tuple):
    """(match, its number) -> its span: what lies before is summed by blocks of STEP."""
    n, b = F.col(f"_n_{family[0]}"), F.col(f"_b_{family[0]}")

    def place(e, i):
        block = F.floor(i / STEP).cast("int")
        before = F.aggregate(F.slice(b, F.lit(1), block), F.lit(0), lambda a, v: a + v)
        near = F.aggregate(F.slice(n, block * STEP + 1, i % STEP), F.lit(0), lambda a, v: a + v)
        return _span(family, e, before + near + e["gap"])

    return place


def _number(kind: int, spans: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


SPAN = "struct<kind:int,start:int,end:int,base:boolean,pattern:int,gazetteer:int,context:int,edges:int,shape:int>"


def candidates(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with one more column ``_spans``: every proposed span, strict families first.

    For each family the text is split at its matches; the sum of what lies before gives
    a match's place. Spans of a looser family that touch a strict span are dropped.
    """
    names = docs.columns
    value = F.coalesce(F.col(text).cast("string"), F.lit(""))
    for family in FAMILIES:
        name, _, pattern, needs, _ = family
        has = value.contains("@") if needs == "@" else value.rlike(needs)
        docs = docs.withColumn(f"_has_{name}", has)
    for family in FAMILIES:
        name, _, pattern, _, _ = family
        docs = docs.withColumns({
            f"_m_{name}": F.when(F.col(f"_has_{name}"), F.regexp_extract_all(value, F.lit(pattern), F.lit(0))),
            f"_g_{name}": F.when(F.col(f"_has_{name}"), F.split(value, pattern, -1))})
    for family in FAMILIES:
        name = family[0]
        m, g = F.col(f"_m_{name}"), F.col(f"_g_{name}")
        n = F.size(m)
        docs = docs.withColumns({
            f"_x_{name}": F.arrays_zip(
                m.alias("m"), F.transform(F.slice(g, F.lit(1), n), F.length).alias("gap"),
                F.transform(F.slice(g, F.lit(1), n), lambda s: F.right(s, F.lit(LEFT))).alias("left"),
                F.transform(F.slice(g, F.lit(2), n), lambda s: F.left(s, F.lit(RIGHT))).alias("right")),
            f"_n_{name}": F.zip_with(m, F.slice(g, F.lit(1), n), lambda a, b: F.length(a) + F.length(b))})
    for family in FAMILIES:
        n = F.col(f"_n_{family[0]}")
        blocks = F.sequence(F.lit(0), F.floor((F.size(n) - 1) / STEP).cast("int"))
        docs = docs.withColumn(f"_b_{family[0]}", F.when(F.size(n) > 0, F.transform(
            blocks, lambda b: F.aggregate(F.slice(n, b * STEP + 1, F.lit(STEP)), F.lit(0), lambda a, v: a + v))))
    found = [F.coalesce(F.transform(f"_x_{family[0]}", _placed(family)), F.array().cast(f"array<{SPAN}>")) for family in FAMILIES]
    strict = [f for f, family in zip(found, FAMILIES) if family[4]]
    loose = [f for f, family in zip(found, FAMILIES) if not family[4]]
    docs = docs.withColumn("_strict", F.concat(*strict)).withColumn("_loose", F.concat(*loose))
    apart = F.filter("_loose", lambda x: ~F.exists("_strict", lambda s: s["base"] & (s["start"] < x["end"]) & (s["end"] > x["start"])))
    return docs.select(*[F.col(f"`{c}`") for c in names], F.concat("_strict", apart).alias("_spans"))


@dataclass(frozen=True)
class Classifier:
    """Logistic weights by feature name, and what expectation-maximisation found."""

    weights: dict
    reliabilities: dict
    priors: dict

    def score(self, span: Column) -> Column:
        total = F.lit(0.0)
        for k, kind in enumerate(KINDS):
            own = F.lit(self.weights.get((k, "bias"), 0.0))
            for vote in VOTES:
                for v in (1, 2):
                    own = own + F.when(span[vote] == v, F.lit(self.weights.get((k, vote, v), 0.0))).otherwise(F.lit(0.0))
            for s in range(4):
                own = own + F.when(span["shape"] == s, F.lit(self.weights.get((k, "shape", s), 0.0))).otherwise(F.lit(0.0))
            total = F.when(span["kind"] == k, own).otherwise(total)
        return 1 / (1 + F.exp(-total))

    def accepts(self, span: Column) -> Column:
        """Base spans, and what the classifier takes of the others. What fails its strict
        condition stays out: the classifier adds forms that the patterns miss."""
        return span["base"] | ((span["pattern"] != 2) & (self.score(span) >= 0.5))


def vote_counts(spans: DataFrame) -> list[tuple]:
    """(kind, votes, shape, number) over all proposed spans: at most 4 * 81 * 4 rows."""
    # explode_outer: explode would first filter on the array's size, and search every text again for it.
    rows = spans.select(F.explode_outer("_spans").alias("s")).where("s IS NOT NULL").groupBy("s.kind", *[f"s.{v}" for v in VOTES], "s.shape").agg(F.count("*").alias("n")).collect()
    return sorted(((r["kind"], tuple(r[v] for v in VOTES), r["shape"], r["n"]) for r in rows))


def fit(counts: list[tuple], rounds: int = 50) -> Classifier:
    """EM over vote patterns of each kind (two classes, votes independent given the class),
    then logistic regression on its posteriors. The start favours labelers that vote for
    what they name; add-one counts keep every probability inside (0, 1)."""
    weights, reliabilities, priors = {}, {}, {}
    for k in range(len(KINDS)):
        own = [(votes, shape, n) for kind, votes, shape, n in counts if kind == k]
        if not own:
            weights[k, "bias"] = -1.0
            continue
        prior = 0.5
        # Probability of each vote (none, for, against) given the class (0 no, 1 yes).
        p = {(v, c): ([0.3, 0.1, 0.6] if c == 0 else [0.3, 0.6, 0.1]) for v in range(len(VOTES)) for c in (0, 1)}
        post = {}
        for _ in range(rounds):
            for votes, shape, _n in own:
                like = [math.log(1 - prior), math.log(prior)]
                for v, vote in enumerate(votes):
                    for c in (0, 1):
                        like[c] += math.log(p[v, c][vote])
                top = max(like)
                post[votes, shape] = math.exp(like[1] - top) / sum(math.exp(x - top) for x in like)
            mass = [2.0, 2.0]
            seen = {key: [1 + 8 * x for x in ([0.3, 0.1, 0.6] if key[1] == 0 else [0.3, 0.6, 0.1])] for key in p}
            for votes, shape, n in own:
                q = post[votes, shape]
                mass[0] += n * (1 - q)
                mass[1] += n * q
                for v, vote in enumerate(votes):
                    seen[v, 0][vote] += n * (1 - q)
                    seen[v, 1][vote] += n * q
            prior = mass[1] / sum(mass)
            p = {key: [x / sum(row) for x in row] for key, row in seen.items()}
        reliabilities[KINDS[k]] = {VOTES[v]: {"for_if_yes": p[v, 1][1], "against_if_no": p[v, 0][2]} for v in range(len(VOTES))}
        priors[KINDS[k]] = prior
        weights |= _logistic(k, [(votes, shape, n, post[votes, shape]) for votes, shape, n in own])
    return Classifier(weights, reliabilities, priors)


def _logistic(kind: int, rows: list[tuple], steps: int = 400, decay: float = 0.01) -> dict:
    """Weighted logistic regression on soft labels by gradient ascent."""
    total = sum(n for _, _, n, _ in rows)
    w: dict = {}
    features = [([(kind, "bias"), (kind, "shape", shape)] + [(kind, VOTES[v], vote) for v, vote in enumerate(votes) if vote], n / total, q) for votes, shape, n, q in rows]
    for _ in range(steps):
        grad: dict = {}
        for names, share, q in features:
            z = max(-30.0, min(30.0, sum(w.get(f, 0.0) for f in names)))
            error = share * (q - 1 / (1 + math.exp(-z)))
            for f in names:
                grad[f] = grad.get(f, 0.0) + error
        for f, g in grad.items():
            w[f] = w.get(f, 0.0) + 2.0 * (g - decay * w.get(f, 0.0))
    return w


def _listed(spans: Column) -> Column:
    """kind:start:end of spans in order of kind and start, comma-joined."""
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["kind"], s["start"], s["end"])))
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def detect(docs: DataFrame) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, base_sha256 (the strict spans), spans (all)."""
    proposed = common.staged(candidates(common.id_text(docs)).select("doc_id", "_spans"), "pii_spans")
    model = fit(vote_counts(proposed))
    base = F.filter("_spans", lambda s: s["base"])
    proposed = proposed.withColumn("_base", base).withColumn("_all", F.filter("_spans", model.accepts))
    counts = [_number(k, "_base").alias(f"n_{kind}") for k, kind in enumerate(KINDS)]
    return proposed.select("doc_id", *counts, F.sha2(_listed(F.col("_base")).cast("binary"), 256).alias("base_sha256"), _listed(F.col("_all")).alias("spans"))


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with every span of ``text`` replaced by its kind in brackets. Spans that
    overlap are replaced as one, named by the first. Rows without spans don't change."""
    proposed = candidates(docs, text)
    model = fit(vote_counts(proposed.select("_spans")))
    accepted = F.array_sort(F.transform(F.filter("_spans", model.accepts), lambda s: F.struct(s["start"], s["end"], s["kind"])))
    proposed = proposed.withColumn("_spans", accepted)
    ends = lambda i: F.aggregate(F.slice("_spans", F.lit(1), i), F.lit(0), lambda a, s: F.greatest(a, s["end"]))  # noqa: E731  where text up to span i is used up
    names = F.array(*[F.lit(f"[{k.upper()}]") for k in KINDS])

    def piece(s, i):
        used = ends(i)
        between = F.substring(F.col(f"`{text}`"), used + 1, s["start"] - used)
        return F.when(s["start"] >= used, F.concat(between, F.get(names, s["kind"]))).otherwise(F.lit(""))

    changed = F.concat(F.array_join(F.transform("_spans", piece), ""), F.substring(F.col(f"`{text}`"), ends(F.size("_spans")) + 1, F.length(f"`{text}`")))
    return proposed.withColumn(text, F.when(F.size("_spans") > 0, changed).otherwise(F.col(f"`{text}`"))).drop("_spans")
