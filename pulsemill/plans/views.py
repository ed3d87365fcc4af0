"""Telemetry views over the given tables, once as DataFrames and once as SQL for the comparison engine.

All views are projections of whole tables: no sampling, no row subset.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pulsemill.operators.ranges import dealt
from pulsemill.session import prepare


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{folder}/{name}.parquet")


def ms(column: str) -> str:
    return f"unix_millis(CAST({column} AS TIMESTAMP))"


# How each engine puts an md5 into the 8-4-4-4-12 form, with one digest an id.
UUID_HERE = ("overlay(overlay(overlay(overlay(", ", '-', 21, 0), '-', 17, 0), '-', 13, 0), '-', 9, 0)")
UUID_THERE = ("CAST(CAST(", " AS UUID) AS STRING)")


def uuid_text(text: str) -> str:
    """SQL: md5 of ``text`` in the 8-4-4-4-12 form, in Spark's words."""
    return f"{UUID_HERE[0]}md5({text}){UUID_HERE[1]}"


def for_duck(sql: str) -> str:
    """``sql`` with its ids in the comparison engine's words."""
    return sql.replace(UUID_HERE[0], UUID_THERE[0]).replace(UUID_HERE[1], UUID_THERE[1])


def cat(*parts: str) -> str:
    """SQL text concatenation that reads the same in both engines."""
    return " || ".join(p if p.startswith("'") else f"CAST({p} AS STRING)" for p in parts)


LINE_ID = cat("'l'", "l_orderkey", "'-'", "l_partkey", "'-'", "l_suppkey", "'-'", "l_linenumber")
TRACE_OF_LINE = uuid_text(cat("'t'", "l_orderkey"))
TRACE_OF_ORDER = uuid_text(cat("'t'", "o_orderkey"))
ORDER_SPAN = uuid_text(cat("'o'", "o_orderkey"))
ORDER_SPAN_OF_LINE = uuid_text(cat("'o'", "l_orderkey"))
LINE_SPAN = uuid_text(LINE_ID)
BEFORE_LINE_SPAN = uuid_text(cat("'l'", "l_orderkey", "'-'", "l_linenumber - 1"))

POINT_COLUMNS = {
    "name": "CASE WHEN event_id % 97 = 0 THEN ' ' ELSE concat('event/', event_type, '.value') END",
    "value": "value",
    "ts_ms": f"CASE WHEN event_id % 11 = 0 THEN NULL ELSE {ms('ts')} END",
    "source": "CASE WHEN event_id % 7 = 0 THEN NULL ELSE concat('user-', user_id) END",
    "tags": "map('type', event_type, 'k', CASE WHEN event_id % 53 = 0 THEN '  ' ELSE regexp_extract(props, '([0-9]+)', 1) END)",
}


def points_of(events: DataFrame) -> DataFrame:
    """Points with ``id`` and ``event_ms`` (arrival), from event rows; also works on a stream."""
    return events.selectExpr("event_id AS id", f"{ms('ts')} AS event_ms", *[f"{e} AS {c}" for c, e in POINT_COLUMNS.items()])


def pts(spark: SparkSession, folder: str) -> DataFrame:
    return points_of(dealt(table(spark, folder, "events")))


def deltas_of(events: DataFrame) -> DataFrame:
    return events.selectExpr(
        "event_id AS id",
        "concat(CASE WHEN event_id % 2 = 0 THEN '∆' WHEN event_id % 5 = 0 THEN 'Δ' ELSE '' END, event_type, '.hits') AS name",
        "value - 20.0D AS value", f"{ms('ts')} AS ts_ms", "concat('user-', user_id % 10) AS source",
        "map('type', event_type, 'k', regexp_extract(props, '([0-9]+)', 1)) AS tags", "CAST(ts AS TIMESTAMP) AS event_time")


def deltas(spark: SparkSession, folder: str) -> DataFrame:
    return deltas_of(table(spark, folder, "events"))


def counter_readings(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "events").selectExpr(
        "event_id AS id", "event_type AS name", f"{ms('ts')} AS ts_ms", "(event_id * 3) % 1009 AS total")


def observations_of(events: DataFrame) -> DataFrame:
    return events.selectExpr(
        "event_id AS id", "event_type AS name",
        "CASE event_id % 3 WHEN 0 THEN 'gauge' WHEN 1 THEN 'counter' ELSE 'delta' END AS kind",
        "CASE WHEN event_id % 20 = 0 THEN 'clear' WHEN event_id % 20 <= 3 THEN 'dec' ELSE 'inc' END AS op",
        "event_id % 10 + 1 AS n", "value", f"{ms('ts')} AS ts_ms", "CAST(ts AS TIMESTAMP) AS event_time",
        "concat('user-', user_id % 10) AS source", "map('shard', CAST(user_id % 3 AS STRING)) AS tags")


def observations(spark: SparkSession, folder: str) -> DataFrame:
    return observations_of(table(spark, folder, "events"))


def samples(spark: SparkSession, folder: str) -> DataFrame:
    events = table(spark, folder, "events").selectExpr("event_type AS series", f"{ms('ts')} AS ts_ms", "value")
    lines = table(spark, folder, "lineitem").selectExpr(
        "concat(l_returnflag, '|', l_linestatus) AS series", f"{ms('l_shipdate')} AS ts_ms", "l_extendedprice AS value")
    return events.unionByName(lines)


def bulk(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "lineitem").selectExpr(
        "l_returnflag AS series", f"{ms('l_shipdate')} AS minute_ms", "l_quantity AS mean").groupBy(
        "series", "minute_ms", "mean").agg(F.count(F.lit(1)).alias("count"))


def dists(spark: SparkSession, folder: str) -> DataFrame:
    """One distribution per order line; its five centroids often repeat a mean next to each other."""
    mean = "named_struct('mean', {}, 'count', CAST({} AS INT))".format
    return dealt(table(spark, folder, "lineitem")).selectExpr(
        f"{LINE_ID} AS id",
        "CASE WHEN l_orderkey % 83 = 0 THEN '' ELSE concat('order/lines.', lower(l_returnflag)) END AS name",
        "CASE WHEN l_partkey % 41 = 0 THEN array() ELSE array(" + ", ".join((
            mean("l_quantity", "l_linenumber"), mean("l_quantity", "2"),
            mean("round(l_discount * 100, 0) + 0.5", "1"), mean("round(l_tax * 100, 0) + 0.5", "3"),
            mean("l_quantity", "1"))) + ") END AS centroids",
        "CASE l_orderkey % 5 WHEN 0 THEN array('!M') WHEN 1 THEN array('!D', '!M') WHEN 2 THEN array('!H') "
        "WHEN 3 THEN array('!H', '!M', '!D') ELSE array() END AS granularities",
        f"CASE WHEN l_linenumber = 7 THEN NULL ELSE {ms('l_shipdate')} END AS ts_ms",
        f"{ms('l_shipdate')} AS event_ms",
        "CASE WHEN l_suppkey % 9 = 0 THEN ' ' ELSE concat('supp ', l_suppkey) END AS source",
        "map('line status', l_linestatus, 'ship', concat(' mode ', l_linenumber, ' ')) AS tags")


def spans(spark: SparkSession, folder: str) -> DataFrame:
    """Each order is a root span, each order line a child that follows the line before it."""
    pair = "named_struct('key', {}, 'value', {})".format
    orders = dealt(table(spark, folder, "orders")).selectExpr(
        "CASE WHEN o_orderkey % 89 = 0 THEN ' ' ELSE concat('order/', o_orderpriority) END AS name",
        f"{ms('o_orderdate')} AS start_ms", "CAST(o_totalprice AS BIGINT) AS duration_ms",
        "concat('cust-', o_custkey) AS source",
        f"{TRACE_OF_ORDER} AS trace_id", f"{ORDER_SPAN} AS span_id",
        "CAST(NULL AS ARRAY<STRING>) AS parents", "CAST(NULL AS ARRAY<STRING>) AS follows_from",
        f"array({pair(chr(39) + 'status' + chr(39), 'o_orderstatus')}) AS tags")
    lines = dealt(table(spark, folder, "lineitem")).selectExpr(
        "CASE WHEN l_partkey % 89 = 0 THEN '' ELSE concat('line ', l_returnflag) END AS name",
        f"{ms('l_shipdate')} AS start_ms", "CAST(l_quantity * 1000 AS BIGINT) AS duration_ms",
        "CASE WHEN l_suppkey % 13 = 0 THEN NULL ELSE concat('supp-', l_suppkey) END AS source",
        f"{TRACE_OF_LINE} AS trace_id", f"{LINE_SPAN} AS span_id",
        f"array({ORDER_SPAN_OF_LINE}) AS parents",
        f"CASE WHEN l_linenumber > 1 THEN array({BEFORE_LINE_SPAN}) ELSE array() END AS follows_from",
        "array(" + ", ".join((
            pair("'returnflag'", "l_returnflag"), pair("'linestatus'", "l_linestatus"),
            pair("'returnflag'", "concat('line \"', l_linenumber, '\"')"))) + ") AS tags")
    return orders.unionByName(lines)


def logs(spark: SparkSession, folder: str) -> DataFrame:
    """Every order line logs its status; a line with a discount logs a second entry. Some name unknown spans."""
    span = f"CASE WHEN l_orderkey % 50 = 0 THEN {uuid_text(cat(chr(39) + 'x' + chr(39), 'l_orderkey'))} ELSE {LINE_SPAN} END"
    at = f"{ms('l_shipdate')} * 1000"
    # Only numbers are exploded, so a query that reads the ids alone does not deal the columns of the entries.
    return dealt(table(spark, folder, "lineitem")).select("*", F.expr("explode(CASE WHEN l_discount > 0 THEN array(0, 1) ELSE array(0) END) AS _entry")).selectExpr(
        f"{TRACE_OF_LINE} AS trace_id", f"{span} AS span_id", f"CASE _entry WHEN 0 THEN {at} + l_linenumber ELSE {at} + 1000 END AS ts_us",
        "CASE _entry WHEN 0 THEN map('event', concat('status \"', l_linestatus, '\"'), 'flag', concat(l_returnflag, '\n')) "
        "ELSE map('price', CAST(CAST(l_extendedprice AS BIGINT) AS STRING)) END AS fields")


def apps(spark: SparkSession, folder: str) -> DataFrame:
    supplier, nation, region = (table(spark, folder, t) for t in ("supplier", "nation", "region"))
    return (
        supplier.join(nation, supplier.s_nationkey == nation.n_nationkey).join(region, nation.n_regionkey == region.r_regionkey)
        .selectExpr(
            "s_suppkey AS app_id", "r_name AS application", "n_name AS service",
            "CASE WHEN n_nationkey % 2 = 0 THEN NULL ELSE concat('cluster-', n_nationkey) END AS cluster",
            "CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE concat('shard-', s_suppkey % 4) END AS shard",
            "map('env', CASE WHEN s_acctbal > 0 THEN 'prod' ELSE 'test' END, 'service', s_name) AS custom")
    )


def app_points(spark: SparkSession, folder: str) -> DataFrame:
    """Points with the application that sent them; some applications are unknown."""
    return table(spark, folder, "events").selectExpr(
        "event_id AS id", "user_id AS app_id", f"{ms('ts')} AS event_ms", *[f"{e} AS {c}" for c, e in POINT_COLUMNS.items()])


def props_map(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").selectExpr(
        "p_partkey AS id", "map('APP_brand', p_brand, 'app_type', p_type, 'other', p_name, 'App_blank', "
        "CASE WHEN p_size % 2 = 0 THEN ' ' ELSE concat('size ', p_size) END) AS props")


def versions(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").selectExpr(
        "p_partkey AS id",
        "CASE WHEN p_partkey % 17 = 0 THEN '' WHEN p_partkey % 19 = 0 THEN p_name "
        "ELSE concat(CASE WHEN p_partkey % 5 = 0 THEN 'v' ELSE '' END, p_size, '.', p_partkey % 12, '.', p_partkey % 120, "
        "CASE WHEN p_partkey % 3 = 0 THEN '-SNAPSHOT' ELSE '' END) END AS version")


def beats(spark: SparkSession, folder: str) -> DataFrame:
    return beats_of(table(spark, folder, "events"), apps(spark, folder))


def beats_of(events: DataFrame, known: DataFrame) -> DataFrame:
    """Beats of event rows, also of a stream; events of unknown applications stay."""
    rows = events.selectExpr(
        "user_id", f"{ms('ts')} AS ts_ms", "CAST(ts AS TIMESTAMP) AS event_time", "event_type AS component", "concat('user-', user_id % 10) AS source",
        "CASE WHEN event_type = 'signup' THEN map('k', regexp_extract(props, '([0-9]+)', 1), 'kind', event_type) END AS reported_tags")
    joined = rows.join(known, rows.user_id == known.app_id, "left").drop("user_id", "app_id")
    return joined.fillna({"application": "unknown", "service": "unknown"})


def routes(spark: SparkSession) -> DataFrame:
    """The configured destinations: everything but histograms."""
    return spark.createDataFrame([("points",), ("spans",), ("span_logs",)], "entity string")


# The same views for the comparison engine. Maps become one column per key (tag_<key>), arrays stay arrays.
SQL_VIEWS = {
    "pts": """
SELECT event_id AS id, user_id AS app_id, epoch_us(ts) // 1000 AS event_ms,
  CASE WHEN event_id % 97 = 0 THEN ' ' ELSE 'event/' || event_type || '.value' END AS name, value,
  CASE WHEN event_id % 11 = 0 THEN NULL ELSE epoch_us(ts) // 1000 END AS ts_ms,
  CASE WHEN event_id % 7 = 0 THEN NULL ELSE 'user-' || user_id END AS source,
  event_type AS tag_type, CASE WHEN event_id % 53 = 0 THEN '  ' ELSE regexp_extract(props, '[0-9]+') END AS tag_k
FROM events""",
    "deltas": """
SELECT event_id AS id,
  (CASE WHEN event_id % 2 = 0 THEN '∆' WHEN event_id % 5 = 0 THEN 'Δ' ELSE '' END) || event_type || '.hits' AS name,
  value - 20.0 AS value, epoch_us(ts) // 1000 AS ts_ms, 'user-' || (user_id % 10) AS source,
  event_type AS tag_type, regexp_extract(props, '[0-9]+') AS tag_k, ts
FROM events""",
    "counter_readings": """
SELECT event_id AS id, event_type AS name, epoch_us(ts) // 1000 AS ts_ms, (event_id * 3) % 1009 AS total FROM events""",
    "observations": """
SELECT event_id AS id, event_type AS name,
  CASE event_id % 3 WHEN 0 THEN 'gauge' WHEN 1 THEN 'counter' ELSE 'delta' END AS kind,
  CASE WHEN event_id % 20 = 0 THEN 'clear' WHEN event_id % 20 <= 3 THEN 'dec' ELSE 'inc' END AS op,
  event_id % 10 + 1 AS n, value, epoch_us(ts) // 1000 AS ts_ms, 'user-' || (user_id % 10) AS source, 'shard=' || (user_id % 3) AS tags FROM events""",
    "samples": """
SELECT event_type AS series, epoch_us(ts) // 1000 AS ts_ms, value FROM events
UNION ALL SELECT l_returnflag || '|' || l_linestatus, epoch_us(l_shipdate) // 1000, l_extendedprice FROM lineitem""",
    "bulk": """
SELECT l_returnflag AS series, epoch_us(l_shipdate) // 1000 AS minute_ms, l_quantity AS mean, count(*) AS count
FROM lineitem GROUP BY ALL""",
    "dists": f"""
SELECT {LINE_ID} AS id,
  CASE WHEN l_orderkey % 83 = 0 THEN '' ELSE 'order/lines.' || lower(l_returnflag) END AS name,
  CASE WHEN l_partkey % 41 = 0 THEN [] ELSE [l_quantity, l_quantity, round(l_discount * 100, 0) + 0.5,
    round(l_tax * 100, 0) + 0.5, l_quantity] END AS means,
  [l_linenumber, 2, 1, 3, 1] AS counts,
  CASE l_orderkey % 5 WHEN 0 THEN ['!M'] WHEN 1 THEN ['!D', '!M'] WHEN 2 THEN ['!H'] WHEN 3 THEN ['!H', '!M', '!D']
    ELSE [] END AS granularities,
  CASE WHEN l_linenumber = 7 THEN NULL ELSE epoch_us(l_shipdate) // 1000 END AS ts_ms, epoch_us(l_shipdate) // 1000 AS event_ms,
  CASE WHEN l_suppkey % 9 = 0 THEN ' ' ELSE 'supp ' || l_suppkey END AS source,
  l_linestatus AS tag_status, ' mode ' || l_linenumber || ' ' AS tag_ship
FROM lineitem""",
    "spans": f"""
SELECT CASE WHEN o_orderkey % 89 = 0 THEN ' ' ELSE 'order/' || o_orderpriority END AS name,
  epoch_us(o_orderdate) // 1000 AS start_ms, CAST(trunc(o_totalprice) AS BIGINT) AS duration_ms, 'cust-' || o_custkey AS source,
  {TRACE_OF_ORDER} AS trace_id, {ORDER_SPAN} AS span_id, CAST([] AS VARCHAR[]) AS parents,
  CAST([] AS VARCHAR[]) AS follows_from, ['status'] AS tag_keys, [o_orderstatus] AS tag_values
FROM orders
UNION ALL
SELECT CASE WHEN l_partkey % 89 = 0 THEN '' ELSE 'line ' || l_returnflag END,
  epoch_us(l_shipdate) // 1000, CAST(trunc(l_quantity * 1000) AS BIGINT),
  CASE WHEN l_suppkey % 13 = 0 THEN NULL ELSE 'supp-' || l_suppkey END,
  {TRACE_OF_LINE}, {LINE_SPAN}, [{ORDER_SPAN_OF_LINE}],
  CASE WHEN l_linenumber > 1 THEN [{BEFORE_LINE_SPAN}] ELSE [] END,
  ['returnflag', 'linestatus', 'returnflag'], [l_returnflag, l_linestatus, 'line "' || l_linenumber || '"']
FROM lineitem""",
    "logs": f"""
SELECT trace_id, span_id, ts_us + CASE k WHEN 0 THEN l_linenumber ELSE 1000 END AS ts_us,
  CASE k WHEN 0 THEN '{{"event":' || to_json('status "' || l_linestatus || '"') || ',"flag":' || to_json(l_returnflag || chr(10)) || '}}'
    ELSE '{{"price":"' || CAST(trunc(l_extendedprice) AS BIGINT) || '"}}' END AS fields
FROM (SELECT *, {TRACE_OF_LINE} AS trace_id, epoch_us(l_shipdate) // 1000 * 1000 AS ts_us,
    CASE WHEN l_orderkey % 50 = 0 THEN {uuid_text(cat("'x'", 'l_orderkey'))} ELSE {LINE_SPAN} END AS span_id,
    unnest(CASE WHEN l_discount > 0 THEN [0, 1] ELSE [0] END) AS k FROM lineitem)""",
    "apps": """
SELECT s_suppkey AS app_id, r_name AS application, n_name AS service,
  CASE WHEN n_nationkey % 2 = 0 THEN NULL ELSE 'cluster-' || n_nationkey END AS cluster,
  CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE 'shard-' || (s_suppkey % 4) END AS shard,
  CASE WHEN s_acctbal > 0 THEN 'prod' ELSE 'test' END AS custom_env, s_name AS custom_service
FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "props_map": """
SELECT p_partkey AS id, p_brand AS "APP_brand", p_type AS app_type, p_name AS other,
  CASE WHEN p_size % 2 = 0 THEN ' ' ELSE 'size ' || p_size END AS "App_blank" FROM part""",
    "versions": """
SELECT p_partkey AS id,
  CASE WHEN p_partkey % 17 = 0 THEN '' WHEN p_partkey % 19 = 0 THEN p_name
  ELSE (CASE WHEN p_partkey % 5 = 0 THEN 'v' ELSE '' END) || p_size || '.' || (p_partkey % 12) || '.' || (p_partkey % 120)
    || (CASE WHEN p_partkey % 3 = 0 THEN '-SNAPSHOT' ELSE '' END) END AS version FROM part""",
    "beats": """
SELECT epoch_us(ts) // 1000 AS ts_ms, ts, event_type AS component, 'user-' || (user_id % 10) AS source,
  CASE WHEN event_type = 'signup' THEN regexp_extract(props, '[0-9]+') END AS reported_k,
  apps.* REPLACE (coalesce(application, 'unknown') AS application, coalesce(service, 'unknown') AS service)
FROM events LEFT JOIN apps ON user_id = app_id""",
}

NEEDS = {"beats": ["apps"]}


def with_views(*names: str, then: str) -> str:
    """``then`` behind a WITH clause of the named views and what they need."""
    wanted: list[str] = []
    for name in names:
        for n in (*NEEDS.get(name, ()), name):
            if n not in wanted:
                wanted.append(n)
    return for_duck("WITH " + ",\n".join(f"{n} AS ({SQL_VIEWS[n]})" for n in wanted) + then)
