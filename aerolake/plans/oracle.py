"""DuckDB SQL oracles for the registered queries.

The fixture views are CTEs (the SQL of FIXTURES.md part B); each oracle is
``WITH <views it needs> <select>``. Only the driver's raw tables are assumed
to exist as views.
"""

from __future__ import annotations


from aerolake.operators.relevance import B, K1
from aerolake.operators.rollups import python_tokens
from aerolake.plans import catalog as C
from aerolake.plans.context import PAGE_SORT

VIEWS: dict[str, str] = {}
DEPENDS: dict[str, list[str]] = {}


def view(name: str, sql: str, deps: list[str] | None = None) -> None:
    VIEWS[name] = sql
    DEPENDS[name] = deps or []


view("flights", """
SELECT md5(concat_ws('|', cast(l_orderkey AS varchar(20)), cast(l_linenumber AS varchar(20)),
           cast(l_partkey AS varchar(20)), cast(l_suppkey AS varchar(20)),
           cast(cast(l_quantity AS int) AS varchar(20)),
           cast(cast(l_shipdate AS date) AS varchar(20)))) AS FlightId,
       c_mktsegment AS Carrier, no.n_name AS Origin, nd.n_name AS Dest,
       concat('N', cast(l_partkey AS varchar(20))) AS TailNum,
       cast(l_suppkey AS varchar(20)) AS FlightNum,
       cast(l_shipdate AS date) AS FlightDate,
       cast(year(l_shipdate) AS int) AS Year, cast(month(l_shipdate) AS int) AS Month,
       CASE WHEN l_linenumber <> 7 THEN lpad(cast((l_partkey * 7) % 2400 AS varchar(4)), 4, '0') END AS DepTime,
       lpad(cast((l_partkey * 7 + l_linenumber * 100) % 2400 AS varchar(4)), 4, '0') AS ArrTime,
       l_quantity - 25 AS DepDelay,
       l_quantity - 25 + l_linenumber * 4 - 12 AS ArrDelay,
       cast(floor(p_retailprice) AS double) AS Distance
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey
JOIN nation no ON s_nationkey = no.n_nationkey JOIN nation nd ON c_nationkey = nd.n_nationkey""")

view("airplanes", """
SELECT concat('N', cast(p_partkey AS varchar(20))) AS TailNum, p_name AS Owner,
       concat('S', cast(p_size % 7 AS varchar(4))) AS OwnerState, p_brand AS Manufacturer,
       p_type AS Model, cast(1950 + p_size AS varchar(4)) AS ManufacturerYear,
       cast(p_partkey * 7919 AS varchar(20)) AS SerialNumber,
       concat('E', p_brand) AS EngineManufacturer,
       concat(p_type, '-', cast(p_size % 5 AS varchar(4))) AS EngineModel
FROM part""")

view("airlines", """
SELECT DISTINCT c_mktsegment AS CarrierCode, concat(c_mktsegment, ' AIR') AS Name FROM customer""")

view("requests", """
SELECT event_id, ts, event_type,
       concat('{"Origin":"', coalesce(no.n_name, 'XXX'), '","Dest":"', coalesce(nd.n_name, 'XXX'),
              '","Carrier":"',
              CASE event_id % 6 WHEN 0 THEN 'AUTOMOBILE' WHEN 1 THEN 'BUILDING' WHEN 2 THEN 'FURNITURE'
                                WHEN 3 THEN 'HOUSEHOLD' WHEN 4 THEN 'MACHINERY' ELSE 'ZZ' END,
              '","FlightNum":"', cast(user_id AS varchar(20)),
              '","FlightDate":"', cast(cast(ts AS date) AS varchar(20)),
              '","DepDelay":', cast(cast(floor(value) AS int) % 50 - 24 AS varchar(20)), '.0',
              ',"UUID":"', md5(cast(event_id AS varchar(20))), '"',
              CASE WHEN event_type = 'error' THEN '' ELSE '}' END) AS value
FROM events LEFT JOIN nation no ON user_id % 25 = no.n_nationkey
            LEFT JOIN nation nd ON event_id % 26 = nd.n_nationkey""")

_PROMPT = "FROM events WHERE event_id % 10 <> 0 AND event_id % 7 <> 0 AND event_id %"
view("responses", f"""
SELECT md5(cast(event_id AS varchar(20))) AS UUID,
       ts + CASE WHEN event_id % 7 = 0 THEN INTERVAL '30' SECOND ELSE INTERVAL '2' SECOND END AS rs_ts,
       cast(event_id % 4 AS double) AS prediction
FROM events WHERE event_id % 10 <> 0
UNION ALL
SELECT md5(cast(event_id AS varchar(20))), ts + INTERVAL '3' SECOND, cast(event_id % 4 AS double) {_PROMPT} 11 = 0
UNION ALL
SELECT md5(cast(event_id AS varchar(20))), ts + INTERVAL '15' SECOND, cast((event_id + 1) % 4 AS double) {_PROMPT} 13 = 0
UNION ALL
SELECT md5(cast(event_id AS varchar(20))), ts - INTERVAL '3' SECOND, cast((event_id + 2) % 4 AS double) {_PROMPT} 17 = 0""")


def _jx(field: str) -> str:
    return f"json_extract_string(CASE WHEN json_valid(value) THEN value END, '$.{field}')"


view("parsed", f"""
SELECT event_id, ts, json_valid(value) AS is_valid,
       {_jx('Origin')} AS Origin, {_jx('Dest')} AS Dest, {_jx('Carrier')} AS Carrier,
       {_jx('FlightNum')} AS FlightNum, cast({_jx('FlightDate')} AS date) AS FlightDate,
       cast({_jx('DepDelay')} AS double) AS DepDelay, {_jx('UUID')} AS UUID
FROM requests""", ["requests"])

view("valid", "SELECT * FROM parsed WHERE is_valid", ["parsed"])

view("distances", "SELECT Origin, Dest, avg(Distance) AS Distance FROM flights GROUP BY Origin, Dest",
     ["flights"])

view("enriched", """
SELECT v.event_id, v.DepDelay, v.Carrier, v.FlightDate, v.Dest, v.FlightNum, v.Origin, d.Distance,
       cast(dayofyear(v.FlightDate) AS int) AS DayOfYear,
       cast(dayofmonth(v.FlightDate) AS int) AS DayOfMonth,
       cast(isodow(v.FlightDate) - 1 AS int) AS DayOfWeek,
       v.ts AS "Timestamp", md5(cast(v.event_id AS varchar)) AS UUID
FROM valid v LEFT JOIN distances d ON v.Origin = d.Origin AND v.Dest = d.Dest""", ["valid", "distances"])

TS = "strftime(\"Timestamp\", '%Y-%m-%dT%H:%M:%S')"

view("tasks", f"""
SELECT DepDelay, Carrier, FlightDate, Dest, FlightNum, Origin, Distance, DayOfYear, DayOfMonth,
       DayOfWeek, {TS} AS "Timestamp"
FROM enriched""", ["enriched"])

view("first_reply", """
SELECT UUID, rs_ts, prediction FROM (
  SELECT *, row_number() OVER (PARTITION BY UUID ORDER BY rs_ts, prediction) AS rn FROM responses)
WHERE rn = 1""", ["responses"])

view("request_status", """
SELECT r.UUID, f.prediction, CASE WHEN f.UUID IS NOT NULL THEN 'OK' ELSE 'WAIT' END AS status
FROM (SELECT md5(cast(event_id AS varchar)) AS UUID FROM events) r
LEFT JOIN first_reply f ON r.UUID = f.UUID""", ["first_reply"])


def delay_class_sql(x: str) -> str:
    return (f"CASE WHEN {x} IS NULL OR isnan({x}) THEN NULL WHEN {x} < -15 THEN cast(0 AS double) "
            f"WHEN {x} < 0 THEN cast(1 AS double) WHEN {x} < 30 THEN cast(2 AS double) "
            f"ELSE cast(3 AS double) END")


def _with(*names: str) -> str:
    order: list[str] = []

    def visit(n):
        for d in DEPENDS[n]:
            visit(d)
        if n not in order:
            order.append(n)
    for n in names:
        visit(n)
    return "WITH " + ",\n".join(f"{n} AS ({VIEWS[n]})" for n in order) + "\n"


def _lit(v) -> str:
    import datetime as dt
    if v is None:
        return "NULL"
    if isinstance(v, dt.date):
        return f"DATE '{v.isoformat()}'"
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return str(v)


def _where(criteria: dict) -> str:
    preds = [f"{k} = {_lit(v)}" for k, v in criteria.items() if v is not None and v != ""]
    return " AND ".join(preds) if preds else "TRUE"


TOKENS = "list_filter(regexp_split_to_array({x}, '[ \\t\\n\\r\\f]+'), lambda t: t <> '')"


def _bm25(table: str, field: str, query: str) -> tuple[str, str, str]:
    """(CTE text, score expression, match predicate) for BM25 over ``field``."""
    terms: list[str] = []
    for t in python_tokens(query, lower=True):
        if t not in terms:
            terms.append(t)
    tk = TOKENS.format(x=f"lower({field})")
    dfs = ", ".join(f"sum(CASE WHEN list_contains(tk, {_lit(t)}) THEN 1 ELSE 0 END) AS df{i}"
                    for i, t in enumerate(terms))
    cte = (f"bm_tok AS (SELECT *, {tk} AS tk FROM {table}),\n"
           f"bm_stats AS (SELECT count(*) AS N, avg(len(tk)) AS avgdl, {dfs} FROM bm_tok)")
    total = "cast(0 AS double)"
    for i, t in enumerate(terms):
        tf = f"cast(len(list_filter(tk, lambda x: x = {_lit(t)})) AS double)"
        idf = f"ln(1.0 + (cast(N AS double) - cast(df{i} AS double) + 0.5) / (cast(df{i} AS double) + 0.5))"
        norm = f"({K1} * ((1.0 - {B}) + {B} * cast(len(tk) AS double) / avgdl))"
        total = f"({total} + {idf} * {tf} * {K1 + 1.0} / ({tf} + {norm}))"
    match = "list_has_any(tk, [" + ", ".join(_lit(t) for t in terms) + "])"
    return cte, f"round({total}, 6)", match


def _bm25_select(table_view: str, field: str, query: str, cols: str, where: str = "TRUE",
                 tail: str = "") -> str:
    cte, score, match = _bm25(table_view, field, query)
    head = _with(table_view).rstrip("\n")
    return (f"{head},\n{cte}\nSELECT {cols}, {score} AS score FROM bm_tok, bm_stats "
            f"WHERE {match} AND {where} {tail}")


def _keyset_where(keys: list[str], after: dict) -> str:
    ors = []
    for i, k in enumerate(keys):
        same = [f"{p} IS NOT DISTINCT FROM {_lit(after[p])}" for p in keys[:i]]
        if after[k] is not None:
            ors.append("(" + " AND ".join(same + [f"({k} > {_lit(after[k])} OR {k} IS NULL)"]) + ")")
    return " OR ".join(ors)


FLIGHT_COLS = ("FlightId, Carrier, Origin, Dest, TailNum, FlightNum, FlightDate, Year, Month, DepTime, "
               "ArrTime, DepDelay, ArrDelay, Distance")
AIRPLANE_COLS = ", ".join(C.AIRPLANE_FIELDS)
ENRICHED_MSG = ("DepDelay, Carrier, FlightDate, Dest, FlightNum, Origin, Distance, DayOfYear, DayOfMonth, "
                f"DayOfWeek, {TS} AS \"Timestamp\", UUID")
FLAT = ("Origin, FlightNum, DayOfWeek, DayOfYear, DayOfMonth, Dest, DepDelay, "
        f"{TS} AS \"Timestamp\", FlightDate, Carrier, UUID, Distance, "
        "cast(NULL AS double) AS Carrier_index, cast(NULL AS double) AS Origin_index, "
        "cast(NULL AS double) AS Dest_index, cast(NULL AS double) AS Route_index")
RESPONSE_COLS = ("UUID AS key, Origin, DayOfWeek, DayOfYear, DayOfMonth, Dest, DepDelay, "
                 f"{delay_class_sql('DepDelay')} AS prediction, {TS} AS \"Timestamp\", FlightDate, "
                 "Carrier, UUID, Distance")
LABEL_SQL = ("CASE WHEN prediction IS NULL THEN 'Prediction data not available or in unexpected format.' "
             "WHEN prediction = 0 THEN 'Early (15+ Minutes Early)' "
             "WHEN prediction = 1 THEN 'Slightly Early (0-15 Minute Early)' "
             "WHEN prediction = 2 THEN 'Slightly Late (0-30 Minute Delay)' "
             "WHEN prediction = 3 THEN 'Very Late (30+ Minutes Late)' "
             "ELSE 'Unknown prediction value: ' || CASE WHEN prediction = floor(prediction) "
             "THEN cast(cast(floor(prediction) AS bigint) AS varchar) ELSE cast(prediction AS varchar) END END")
INT_RE = "'^[+-]?[0-9]+$'"


def _try_int(x: str) -> str:
    return f"CASE WHEN regexp_matches(trim({x}), {INT_RE}) THEN try_cast(trim({x}) AS int) END"


ROUTE_SQL = "SELECT Origin, Dest, avg(Distance) AS Distance FROM flights GROUP BY Origin, Dest ORDER BY Distance, Origin, Dest"
S_START, S_SIZE = C.FLIGHT_PAGE
A_START, A_SIZE = C.AIRPLANE_PAGE
FLIGHT_ORDER = ", ".join(f"{k} ASC NULLS LAST" for k in C.FLIGHT_SORT)

ORACLE_SQL: dict[str, str] = {
    "route_distance": _with("flights") + ROUTE_SQL,
    "jsonl_roundtrip": _with("flights") + ROUTE_SQL,
    "flights_by_month": _with("flights") + (
        "SELECT Year, Month, count(*) AS total_flights FROM flights GROUP BY Year, Month ORDER BY Year, Month"),
    "flights_by_month_json": _with("flights") + (
        "SELECT cast(to_json({'Year': Year, 'Month': Month, 'total_flights': total_flights}) AS varchar) AS json "
        "FROM (SELECT Year, Month, count(*) AS total_flights FROM flights GROUP BY Year, Month)"),
    "manufacturer_totals": _with("airplanes") + (
        "SELECT Manufacturer, count(*) AS total_airplanes FROM airplanes GROUP BY Manufacturer "
        "ORDER BY total_airplanes DESC, Manufacturer"),
    "flights_per_airplane": _with("flights") + (
        "SELECT f.TailNum, FlightId, FlightDate, Carrier, FlightNum, Origin, Dest, DepTime, ArrTime, n_flights "
        "FROM flights f JOIN (SELECT TailNum, count(*) AS n_flights FROM flights GROUP BY TailNum) c "
        "ON f.TailNum = c.TailNum"),
    "airplane_documents": _with("flights") + (
        "SELECT TailNum, row_number() OVER (PARTITION BY TailNum ORDER BY FlightDate, FlightId) - 1 AS place, FlightId, FlightDate, "
        "Carrier, FlightNum, Origin, Dest, DepTime, ArrTime, count(*) OVER (PARTITION BY TailNum) AS n_flights FROM flights "
        "WHERE TailNum IS NOT NULL"),
    "airplane_document": _with("flights") + (
        "SELECT TailNum, row_number() OVER (ORDER BY FlightDate, FlightId) - 1 AS place, FlightId, FlightDate, "
        f"Carrier, FlightNum, Origin, Dest, DepTime, ArrTime FROM flights WHERE TailNum = '{C.TAIL_NUMBER}'"),
    "carrier_documents": _with("flights") + (
        ", pairs AS (SELECT DISTINCT Carrier, TailNum FROM flights WHERE Carrier IS NOT NULL) "
        "SELECT Carrier, row_number() OVER (PARTITION BY Carrier ORDER BY TailNum NULLS LAST) - 1 AS place, TailNum, "
        "count(*) OVER (PARTITION BY Carrier) AS n_airplanes FROM pairs"),
    "airplanes_per_carrier": _with("flights") + (
        ", pairs AS (SELECT DISTINCT Carrier, TailNum FROM flights) "
        "SELECT p.Carrier, p.TailNum, c.n_airplanes FROM pairs p JOIN "
        "(SELECT Carrier, count(*) AS n_airplanes FROM pairs GROUP BY Carrier) c ON p.Carrier = c.Carrier"),
    "all_airlines": _with("flights") + (
        "SELECT Carrier, count(DISTINCT TailNum) AS n_airplanes, count(*) AS n_flights FROM flights GROUP BY Carrier"),
    "airline_profile": _with("flights", "airlines") + (
        "SELECT coalesce(a.CarrierCode, s.Carrier) AS CarrierCode, a.Name, s.n_airplanes, s.n_flights "
        "FROM airlines a FULL OUTER JOIN (SELECT Carrier, count(DISTINCT TailNum) AS n_airplanes, "
        "count(*) AS n_flights FROM flights GROUP BY Carrier) s ON a.CarrierCode = s.Carrier"),
    "word_count": (
        "SELECT word, count(*) AS n FROM (SELECT unnest(regexp_split_to_array(text, '[ \\t\\n\\r\\f]+')) AS word "
        "FROM documents) WHERE word <> '' GROUP BY word"),
    "flight_lookup": _with("flights") + (
        f"SELECT {FLIGHT_COLS} FROM flights WHERE {_where(C.LOOKUP)} ORDER BY FlightId LIMIT 1"),
    "list_flights": _with("flights") + (
        f"SELECT {FLIGHT_COLS} FROM flights WHERE {_where(C.ROUTE_DAY)} ORDER BY DepTime, ArrTime, FlightId"),
    "list_flights_count": _with("flights") + (
        f"SELECT count(*) AS flight_count FROM flights WHERE {_where(C.ROUTE_DAY)}"),
    "flights_of_airplane": _with("flights") + (
        f"SELECT {FLIGHT_COLS} FROM flights WHERE TailNum = {_lit(C.TAIL_NUMBER)} ORDER BY FlightDate, FlightId"),
    "search_flights": _with("flights") + (
        f"SELECT {FLIGHT_COLS}, cast(0 AS double) AS score FROM flights WHERE {_where(C.FLIGHT_SEARCH)} "
        f"ORDER BY {FLIGHT_ORDER}, score DESC, FlightId LIMIT {S_SIZE} OFFSET {S_START}"),
    "search_flights_count": _with("flights") + (
        f"SELECT count(*) AS total FROM flights WHERE {_where(C.FLIGHT_SEARCH)}"),
    "search_airplanes": _bm25_select(
        "airplanes", "Owner", C.AIRPLANE_SEARCH["Owner"], AIRPLANE_COLS,
        where=_where({k: v for k, v in C.AIRPLANE_SEARCH.items() if k not in C.AIRPLANE_TEXT_FIELDS}),
        tail=f"ORDER BY Owner ASC NULLS LAST, score DESC, TailNum LIMIT {A_SIZE} OFFSET {A_START}"),
    "search_airplanes_count": "SELECT count(*) AS total FROM (" + _bm25_select(
        "airplanes", "Owner", C.AIRPLANE_SEARCH["Owner"], "TailNum",
        where=_where({k: v for k, v in C.AIRPLANE_SEARCH.items() if k not in C.AIRPLANE_TEXT_FIELDS})) + ")",
    "match_relevance": _bm25_select("airplanes", "Owner", C.OWNER_QUERY, "TailNum, Owner"),
    "match_relevance_documents": (
        "WITH " + _bm25("documents", "text", C.DOCUMENT_QUERY)[0] + "\nSELECT doc_id, "
        + _bm25("documents", "text", C.DOCUMENT_QUERY)[1] + " AS score FROM bm_tok, bm_stats WHERE "
        + _bm25("documents", "text", C.DOCUMENT_QUERY)[2]),
    "flights_page_keyset": _with("flights") + (
        f"SELECT {FLIGHT_COLS} FROM flights WHERE {_keyset_where(C.KEYSET_SORT, C.KEYSET_AFTER)} "
        f"ORDER BY {', '.join(k + ' NULLS LAST' for k in C.KEYSET_SORT)} LIMIT {C.KEYSET_SIZE}"),
    "delay_bucket": _with("flights") + (
        f"SELECT FlightId, ArrDelay, {delay_class_sql('ArrDelay')} AS ArrDelayBucket FROM flights"),
    "category_index": _with("flights") + (
        ", r AS (SELECT Carrier, Origin, Dest, Origin || '-' || Dest AS Route FROM flights), "
        "stacked AS (SELECT 'Carrier' AS \"column\", Carrier AS value FROM r UNION ALL "
        "SELECT 'Origin', Origin FROM r UNION ALL SELECT 'Dest', Dest FROM r UNION ALL "
        "SELECT 'Route', Route FROM r), "
        "counts AS (SELECT \"column\", value, count(*) AS n FROM stacked WHERE value IS NOT NULL GROUP BY 1, 2) "
        "SELECT \"column\", value, n, cast(row_number() OVER (PARTITION BY \"column\" ORDER BY n DESC, value) - 1 "
        "AS double) AS idx FROM counts"),
    "request_parse": _with("parsed") + (
        "SELECT event_id, Origin, Dest, Carrier, FlightNum, FlightDate, DepDelay, UUID, is_valid FROM parsed"),
    "coerce_fields": _with("requests") + (
        "SELECT event_id, try_cast(trim(t_dep) AS double) AS DepDelay, " + _try_int("t_dep") + " AS DepDelay_int, "
        "t_car AS Carrier, t_date AS FlightDate, t_dest AS Dest, t_num AS FlightNum, "
        + _try_int("t_num") + " AS FlightNum_int, t_orig AS Origin FROM (SELECT event_id, "
        f"{_jx('DepDelay')} AS t_dep, {_jx('Carrier')} AS t_car, {_jx('FlightDate')} AS t_date, "
        f"{_jx('Dest')} AS t_dest, {_jx('FlightNum')} AS t_num, {_jx('Origin')} AS t_orig FROM requests)"),
    "date_features": _with("valid") + (
        "SELECT event_id, FlightDate, cast(dayofyear(FlightDate) AS int) AS DayOfYear, "
        "cast(dayofmonth(FlightDate) AS int) AS DayOfMonth, cast(isodow(FlightDate) - 1 AS int) AS DayOfWeek "
        "FROM valid"),
    "enrich_distance": _with("valid", "distances") + (
        "SELECT v.event_id, v.Origin, v.Dest, d.Distance FROM valid v "
        "LEFT JOIN distances d ON v.Origin = d.Origin AND v.Dest = d.Dest"),
    "make_requests": _with("enriched") + f"SELECT UUID AS key, {ENRICHED_MSG} FROM enriched",
    "request_flatten": _with("enriched") + f"SELECT {FLAT} FROM enriched",
    "request_features": _with("enriched") + f"SELECT {FLAT}, Origin || '-' || Dest AS Route FROM enriched",
    "make_tasks": _with("tasks") + "SELECT * FROM tasks",
    "batch_results_for_day": _with("tasks") + (
        "SELECT *, true AS in_classes FROM tasks "
        f"WHERE \"Timestamp\" >= {_lit(C.RESULT_DAY)} AND \"Timestamp\" <= "
        f"cast(cast({_lit(C.RESULT_DAY)} AS date) + INTERVAL 1 DAY AS date)::varchar"),
    "response_messages": _with("enriched") + f"SELECT {RESPONSE_COLS} FROM enriched",
    "response_lookup": _with("enriched") + (
        f"SELECT {RESPONSE_COLS} FROM enriched WHERE UUID = md5('{C.LOOKUP_UUID_EVENT}') LIMIT 1"),
    "request_status": _with("request_status") + "SELECT UUID, prediction, status FROM request_status",
    "prediction_label": _with("request_status") + f"SELECT UUID, prediction, {LABEL_SQL} AS label FROM request_status",
    "delay_regression": _with("flights") + (
        "SELECT round(regr_slope(ArrDelay, DepDelay), 6) AS slope, "
        "round(regr_intercept(ArrDelay, DepDelay), 6) AS intercept, count(*) AS n FROM flights"),
}

ORACLE_SQL["stream_parse"] = _with("parsed") + (
    "SELECT md5(cast(event_id AS varchar)) AS key, Origin, Dest, Carrier, FlightNum, FlightDate, DepDelay, "
    "UUID, is_valid FROM parsed")
ORACLE_SQL["request_response_stream"] = _with("responses") + (
    ", r AS (SELECT md5(cast(event_id AS varchar)) AS UUID, ts AS rq_ts FROM events), "
    "inside AS (SELECT r.UUID, r.rq_ts, s.prediction, s.rs_ts IS NOT NULL AS hit, row_number() OVER "
    "(PARTITION BY r.UUID, r.rq_ts ORDER BY s.rs_ts, s.prediction) AS rn FROM r LEFT JOIN responses s "
    "ON r.UUID = s.UUID AND s.rs_ts >= r.rq_ts AND s.rs_ts <= r.rq_ts + INTERVAL 20 SECOND) "
    "SELECT UUID, CASE WHEN hit THEN 'OK' ELSE 'TIMEOUT' END AS status, prediction FROM inside WHERE rn = 1")

ORACLE_SQL["response_lookup_stream"] = ORACLE_SQL["response_lookup"]

for _name in ("route_distance", "flights_by_month", "airplanes_per_carrier", "manufacturer_totals"):
    ORACLE_SQL[f"{_name}_refreshed"] = ORACLE_SQL[_name]

ORACLE_SQL["flight_lookup_many"] = _with("flights") + (
    f"SELECT {FLIGHT_COLS} FROM (SELECT *, row_number() OVER (PARTITION BY Carrier, FlightDate, FlightNum "
    "ORDER BY FlightId) AS rn FROM flights) WHERE rn = 1")

_RANKS = ", ".join(
    f"r_{c} AS (SELECT v, cast(row_number() OVER (ORDER BY n DESC, v) - 1 AS double) AS i FROM "
    f"(SELECT {c} AS v, count(*) AS n FROM feat WHERE {c} IS NOT NULL GROUP BY {c}))"
    for c in ["Carrier", "Origin", "Dest", "Route"])
ORACLE_SQL["assemble_features"] = _with("flights") + (
    ", feat AS (SELECT *, Origin || '-' || Dest AS Route FROM flights), " + _RANKS + " "
    "SELECT f.FlightId, " + delay_class_sql("f.ArrDelay") + " AS ArrDelayBucket, "
    "f.DepDelay AS f_DepDelay, f.Distance AS f_Distance, "
    "cast(dayofyear(f.FlightDate) AS double) AS f_DayOfYear, cast(dayofmonth(f.FlightDate) AS double) AS f_DayOfMonth, "
    "cast(isodow(f.FlightDate) - 1 AS double) AS f_DayOfWeek, "
    "rc.i AS f_Carrier_index, ro.i AS f_Origin_index, rd.i AS f_Dest_index, rr.i AS f_Route_index "
    "FROM feat f JOIN r_Carrier rc ON f.Carrier = rc.v JOIN r_Origin ro ON f.Origin = ro.v "
    "JOIN r_Dest rd ON f.Dest = rd.v JOIN r_Route rr ON f.Route = rr.v")

# Model and stream outputs: the request fields, and flags that must hold for every row.
_FIELDS = ENRICHED_MSG + ", Origin || '-' || Dest AS Route, true AS in_classes"
ORACLE_SQL["score_batch"] = _with("enriched") + f"SELECT {_FIELDS} FROM enriched"
ORACLE_SQL["model_roundtrip"] = _with("enriched") + f"SELECT {_FIELDS}, true AS same FROM enriched"
ORACLE_SQL["score_tasks"] = _with("tasks") + "SELECT *, true AS in_classes FROM tasks"
ORACLE_SQL["delay_regression_predict"] = _with("tasks") + "SELECT *, true AS has_delay FROM tasks"
ORACLE_SQL["train_metrics"] = _with("flights") + (
    f", c AS (SELECT {delay_class_sql('ArrDelay')} AS k, count(*) AS n FROM flights "
    "WHERE substr(md5(FlightId), 1, 4) < '3333' GROUP BY 1) "
    "SELECT cast(sum(n) AS bigint) AS n_test, cast(max(n) AS double) / cast(sum(n) AS double) AS majority_rate, "
    "10 AS num_trees, true AS beats_majority FROM c WHERE k IS NOT NULL")
ORACLE_SQL["regression_report"] = _with("flights") + (
    ", v AS (SELECT 'o' AS c, Origin AS v FROM flights UNION SELECT 'd', Dest FROM flights UNION SELECT 'n', FlightNum FROM flights) "
    "SELECT count(*) AS n, count(*) FILTER (ArrDelay IS NULL) AS n_without_label, "
    "count(*) FILTER (Origin IS NULL OR Dest IS NULL OR FlightNum IS NULL OR Distance IS NULL OR FlightDate IS NULL) AS n_incomplete, "
    "(SELECT count(*) FROM v WHERE v IS NOT NULL) AS n_categories, 1024 AS slots FROM flights")

# The scorer reads every message; a malformed one becomes a row of nulls.
_TYPES = {"DepDelay": "double", "FlightDate": "date", "Distance": "double", "DayOfYear": "int", "DayOfMonth": "int", "DayOfWeek": "int"}
_NAMES = ["DepDelay", "Carrier", "FlightDate", "Dest", "FlightNum", "Origin", "Distance", "DayOfYear", "DayOfMonth", "DayOfWeek"]
_NULLS = ", ".join(f"cast(NULL AS {_TYPES.get(c, 'varchar')}) AS {c}" for c in _NAMES) + ", cast(NULL AS varchar) AS \"Timestamp\", cast(NULL AS varchar) AS UUID"
_MESSAGES = f"SELECT {ENRICHED_MSG} FROM enriched UNION ALL SELECT {_NULLS} FROM parsed WHERE NOT is_valid"
for _name in ("stream_score", "stream_sink_json", "stream_sink_store"):
    ORACLE_SQL[_name] = _with("enriched", "parsed") + (
        f"SELECT *, Origin || '-' || Dest AS Route, true AS in_classes, true AS same FROM ({_MESSAGES})")
ORACLE_SQL["stream_fanout"] = _with("enriched", "parsed") + (
    f"SELECT sink, m.* EXCLUDE (FlightNum), true AS in_classes FROM ({_MESSAGES}) m, "
    "(SELECT unnest(['store', 'json', 'topic']) AS sink)")

ORACLE_SQL["stream_fanout_once"] = ORACLE_SQL["stream_fanout"]
# Even events meet the first publication of the routes, odd ones the second.
ORACLE_SQL["stream_enrich"] = _with("valid", "distances") + (
    ", early AS (SELECT Origin, Dest, avg(Distance) AS Distance FROM flights WHERE FlightDate < DATE '1995-01-01' GROUP BY Origin, Dest) "
    "SELECT md5(cast(v.event_id AS varchar)) AS UUID, v.Origin, v.Dest, CASE WHEN v.event_id % 2 = 0 THEN e.Distance ELSE d.Distance END AS Distance "
    "FROM valid v LEFT JOIN early e ON v.Origin = e.Origin AND v.Dest = e.Dest LEFT JOIN distances d ON v.Origin = d.Origin AND v.Dest = d.Dest")
# At the optimum the weighted errors of every category cancel out.
ORACLE_SQL["delay_regression_exact"] = _with("flights") + (
    "SELECT \"column\", value, count(*) AS n, cast(0 AS double) AS mean_gradient FROM ("
    "SELECT unnest(['Origin', 'Dest', 'FlightNum']) AS \"column\", unnest([Origin, Dest, FlightNum]) AS value FROM flights WHERE ArrDelay IS NOT NULL) "
    "WHERE value IS NOT NULL GROUP BY 1, 2")

ORACLE_SQL["airline_airplanes"] = _with("flights", "airlines") + (
    ", pairs AS (SELECT DISTINCT Carrier, TailNum FROM flights), "
    "fleet AS (SELECT *, count(*) OVER (PARTITION BY Carrier) AS n_airplanes FROM pairs) "
    "SELECT coalesce(a.CarrierCode, f.Carrier) AS CarrierCode, a.Name, f.TailNum, f.n_airplanes "
    "FROM fleet f FULL OUTER JOIN airlines a ON a.CarrierCode = f.Carrier")
ORACLE_SQL["month_counts_stored"] = ORACLE_SQL["flights_by_month"]
ORACLE_SQL["manufacturer_totals_stored"] = ORACLE_SQL["manufacturer_totals"]
ORACLE_SQL["views_sql"] = (
    "SELECT cast(year(l_shipdate) AS int) AS ship_year, count(*) AS n_items, count(DISTINCT l_partkey) AS n_parts "
    "FROM lineitem GROUP BY 1")
ORACLE_SQL["flights_page_keyset_null"] = _with("flights") + (
    f"SELECT {FLIGHT_COLS} FROM flights WHERE {_keyset_where(C.KEYSET_SORT, C.KEYSET_AFTER_NULL)} "
    f"ORDER BY {', '.join(k + ' NULLS LAST' for k in C.KEYSET_SORT)} LIMIT {C.KEYSET_SIZE}")


def _text_search(table: str, criteria: dict, text_fields: list[str], cols: str, order: str, size: int) -> str:
    """One page of a search that matches words in several fields: scores add up."""
    ctes, scores, matches, source = [], [], [], table
    exact = _where({k: v for k, v in criteria.items() if k not in text_fields})
    for i, field in enumerate(f for f in sorted(text_fields) if criteria.get(f)):
        cte, score, match = _bm25(table, field, criteria[field])
        for name in ("bm_tok", "bm_stats"):
            cte = cte.replace(name, f"{name}{i}")
        ctes.append(cte)
        score = score[len("round("):-len(", 6)")]
        ctes.append(f"bm_hit{i} AS (SELECT {cols.split(',')[0]} AS _id, {score} AS s FROM bm_tok{i}, bm_stats{i} WHERE {match})")
        scores.append(f"h{i}.s")
        matches.append(f"JOIN bm_hit{i} h{i} ON h{i}._id = t.{cols.split(',')[0]}")
    return (_with(table).rstrip("\n") + ",\n" + ",\n".join(ctes)
            + f"\nSELECT {', '.join('t.' + c.strip() for c in cols.split(','))}, round({' + '.join(scores)}, 6) AS score "
            f"FROM {source} t {' '.join(matches)} WHERE {exact} ORDER BY {order.format(score=' + '.join(scores))} LIMIT {size}")


ORACLE_SQL["search_airplanes_text"] = _text_search(
    "airplanes", C.AIRPLANE_TEXT_SEARCH, C.AIRPLANE_TEXT_FIELDS_ALL, AIRPLANE_COLS, "{score} DESC, t.TailNum", 50)
ORACLE_SQL["search_flights_text"] = _text_search(
    "flights", C.FLIGHT_TEXT_SEARCH, C.FLIGHT_TEXT_FIELDS, FLIGHT_COLS, "t.FlightDate NULLS LAST, {score} DESC, t.FlightId", 50)

# The tables behind these are built from the same rows that the SQL reads.
ORACLE_SQL["match_terms_documents"] = ORACLE_SQL["match_relevance_documents"]
_doc_cte, _doc_score, _doc_match = _bm25("documents", "text", C.DOCUMENT_QUERY)
ORACLE_SQL["match_top_k"] = (
    f"WITH {_doc_cte}\nSELECT doc_id, {_doc_score} AS score FROM bm_tok, bm_stats WHERE {_doc_match} "
    f"ORDER BY {_doc_score[len('round('):-len(', 6)')]} DESC, doc_id LIMIT {C.TOP_K}")
_PAGE_ORDER = ", ".join(f"{k} NULLS LAST" for k in PAGE_SORT)
ORACLE_SQL["flights_page_at"] = _with("flights") + (
    f"SELECT {FLIGHT_COLS} FROM (SELECT *, row_number() OVER (ORDER BY {_PAGE_ORDER}) - 1 AS pos, count(*) OVER () AS n FROM flights) "
    f"WHERE pos >= n // 2 AND pos < n // 2 + {C.PAGE_AT_SIZE}")
ORACLE_SQL["search_page_at"] = _with("flights") + (
    f"SELECT {FLIGHT_COLS} FROM flights WHERE Carrier = '{C.PAGE_CARRIER}' ORDER BY {_PAGE_ORDER} "
    f"LIMIT {C.PAGE_AT_SIZE} OFFSET {C.CARRIER_PAGE_AT}")

# A request ends at the first silence after it: of the messages that nothing follows
# within 20 s, the first from the request on; or at once, if its own 20 s stay empty.
ORACLE_SQL["request_response_silence"] = _with("responses") + (
    ", r AS (SELECT md5(cast(event_id AS varchar)) AS UUID, ts AS rq_ts FROM events), "
    "m AS (SELECT rs_ts, lead(rs_ts) OVER (ORDER BY rs_ts) AS next_ts FROM (SELECT DISTINCT rs_ts FROM responses)), "
    "gaps AS (SELECT rs_ts AS last_ts FROM m WHERE next_ts IS NULL OR next_ts - rs_ts > INTERVAL 20 SECOND), "
    "a AS (SELECT r.*, m.rs_ts AS first_ts FROM r ASOF LEFT JOIN m ON r.rq_ts <= m.rs_ts), "
    "e AS (SELECT UUID, rq_ts, CASE WHEN first_ts IS NULL OR first_ts - rq_ts > INTERVAL 20 SECOND THEN rq_ts ELSE last_ts END "
    "+ INTERVAL 20 SECOND AS end_ts FROM a ASOF LEFT JOIN gaps ON a.rq_ts <= gaps.last_ts), "
    "inside AS (SELECT e.UUID, e.rq_ts, s.prediction, s.rs_ts IS NOT NULL AS hit, row_number() OVER "
    "(PARTITION BY e.UUID, e.rq_ts ORDER BY s.rs_ts, s.prediction) AS rn FROM e LEFT JOIN responses s "
    "ON e.UUID = s.UUID AND s.rs_ts >= e.rq_ts AND s.rs_ts <= e.end_ts) "
    "SELECT UUID, CASE WHEN hit THEN 'OK' ELSE 'TIMEOUT' END AS status, prediction FROM inside WHERE rn = 1")

_POLL = _with("enriched") + (
    ", asked AS (SELECT md5(cast(event_id AS varchar)) AS UUID FROM events) "
    "SELECT a.UUID, CASE WHEN e.UUID IS NULL THEN 'WAIT' ELSE 'OK' END AS status, e.Origin, e.DayOfWeek, e.DayOfYear, e.DayOfMonth, e.Dest, "
    f"e.DepDelay, {delay_class_sql('e.DepDelay')} AS prediction, strftime(e.\"Timestamp\", '%Y-%m-%dT%H:%M:%S') AS \"Timestamp\", "
    "e.FlightDate, e.Carrier, e.Distance FROM asked a LEFT JOIN enriched e ON a.UUID = e.UUID")
ORACLE_SQL["result_poll_all"] = _POLL
ORACLE_SQL["result_poll"] = _POLL + f" WHERE a.UUID = md5('{C.LOOKUP_UUID_EVENT}')"
