"""Queries over points, names, tags and application tags."""

from __future__ import annotations

from pyspark.sql import functions as F

from pulsemill.functions import tags as tag_fn
from pulsemill.functions.text import (
    blank, delta_name, number_text, sanitize_name, sanitize_tag_value, semver_number, with_default_source,
)
from pulsemill.functions.time import bin_start, duration_us, epoch_ms, epoch_us
from pulsemill.model import GRANULARITY_MS
from pulsemill.operators import encode, enrich, validate
from pulsemill.plans import sqltext as q
from pulsemill.plans import views
from pulsemill.plans.views import with_views
from pulsemill.session import prepare
from pulsemill.sources import readers


def scan_points(spark, folder):
    points = readers.scan_points(prepare(spark), f"{folder}/events.parquet", columns=views.POINT_COLUMNS)
    return points.withColumn("tags", tag_fn.tags_text(F.col("tags")))


def sanitize_names(spark, folder):
    """Raw texts that become the same name, and how long the name is."""
    texts = views.table(spark, folder, "documents").select(F.col("text").alias("raw")).unionByName(
        views.table(spark, folder, "pages").select(F.col("url").alias("raw")))
    # Texts are reduced to digests before the shuffle; equal copies are counted before names are compared.
    name = sanitize_name(F.col("raw"))
    narrow = texts.filter(~blank(F.col("raw"))).select(
        F.md5("raw").alias("raw_md5"), F.md5(name).alias("name_md5"), F.length(name).alias("name_length"))
    copies = narrow.groupBy("raw_md5", "name_md5", "name_length").count()
    return copies.groupBy("name_md5", "name_length").agg(F.count(F.lit(1)).alias("raw_names"), F.sum("count").alias("n_rows"))


def sanitize_tag_values(spark, folder):
    """How tag values change when cleaned, per language and source of the texts."""
    docs = views.table(spark, folder, "documents").withColumn("clean", sanitize_tag_value(F.col("text")))
    return docs.groupBy("lang", "source").agg(
        F.count(F.lit(1)).alias("n_values"),
        F.count_if(F.col("clean").contains('\\"')).alias("n_escaped"),
        F.count_if(F.length("clean") < F.length("text") + 2).alias("n_trimmed"),
        F.sum(F.length("clean").cast("bigint")).alias("clean_length"),
        F.min(F.md5("clean")).alias("least_md5"))


def format_numbers(spark, folder):
    orders = views.table(spark, folder, "orders")
    price = F.col("o_totalprice")
    return orders.select(
        "o_orderkey", number_text(price).alias("plain"), number_text(F.floor(price).cast("double")).alias("whole"),
        number_text(price * 1000003).alias("large"), number_text(-price / 1e9).alias("small"),
        number_text(price * 1e17).alias("huge"), number_text(price / 1e12).alias("tiny"))


def encode_metric_lines(spark, folder):
    return encode.encode_metric_lines(views.pts(spark, folder)).select("id", "line")


def encode_delta_lines(spark, folder):
    return encode.encode_delta_lines(views.deltas(spark, folder)).select("id", "line")


def delta_names(spark, folder):
    return views.deltas(spark, folder).groupBy(delta_name(F.col("name")).alias("name")).agg(
        F.count_distinct("name").alias("raw_names"), F.count(F.lit(1)).alias("n_rows"))


def default_source(spark, folder):
    return views.pts(spark, folder).groupBy(with_default_source(F.col("source"), "fallback-host").alias("source")).agg(
        F.count(F.lit(1)).alias("n_points"))


def semver_numbers(spark, folder):
    return views.versions(spark, folder).groupBy("version").agg(F.count(F.lit(1)).alias("n_parts")).withColumn(
        "number", semver_number(F.col("version")))


def epoch_columns(spark, folder):
    events = views.table(spark, folder, "events")
    midnight = F.date_trunc("day", F.col("ts"))
    return events.select(
        "event_id", epoch_ms(F.col("ts")).alias("ms"), epoch_us(F.col("ts")).alias("us"),
        duration_us(midnight, F.col("ts")).alias("day_us"))


def minute_bin(spark, folder):
    """Activity per bin of each granularity."""
    pts = views.pts(spark, folder)
    bins = F.array(*[
        F.struct(F.lit(g).alias("granularity"), bin_start(F.col("event_ms"), w).alias("start_ms"))
        for g, w in GRANULARITY_MS.items()])
    # Minutes are counted first; the wider bins then sum minutes instead of points.
    minutes = pts.groupBy(bin_start(F.col("event_ms")).alias("event_ms")).agg(F.count(F.lit(1)).alias("n"))
    return minutes.select(F.inline(bins), "n").groupBy("granularity", "start_ms").agg(F.sum("n").alias("n_points"))


def app_point_tags(spark, folder):
    app = [F.col(c) for c in ("application", "service", "cluster", "shard", "custom")]
    return views.apps(spark, folder).select("app_id", tag_fn.tags_text(tag_fn.app_point_tags(*app)).alias("tags"))


def tags_by_pattern(spark, folder):
    props = views.props_map(spark, folder)
    return props.select(
        "id", tag_fn.tags_text(tag_fn.tags_by_pattern(F.col("props"), "^APP.*$")).alias("selected"),
        tag_fn.tags_text(tag_fn.tag_from_property(F.col("props"), "App_blank", "size")).alias("renamed"))


def validate_points(spark, folder):
    checked = validate.validate_points(views.pts(spark, folder))
    return checked.groupBy(F.coalesce(validate.REASON, F.lit("valid")).alias("verdict")).agg(
        F.count(F.lit(1)).alias("n_points"), F.sum("id").alias("id_sum"))


def positive_deltas(spark, folder):
    return validate.positive_deltas(views.deltas(spark, folder)).select("id", "name", F.round("value", 6).alias("value"))


def route_entities(spark, folder):
    """Records per entity that have a destination and that are discarded."""
    rows = views.pts(spark, folder).select(F.lit("points").alias("entity")).unionByName(
        views.dists(spark, folder).select(F.lit("histograms").alias("entity")))
    routes = views.routes(spark)
    kept = validate.route_entities(rows, routes).groupBy("entity").agg(F.count(F.lit(1)).alias("n")).withColumn("routed", F.lit(True))
    lost = validate.route_entities(rows, routes, routed=False).groupBy("entity").agg(
        F.count(F.lit(1)).alias("n")).withColumn("routed", F.lit(False))
    return kept.unionByName(lost)


def enrich_points(spark, folder):
    enriched = enrich.enrich_points(views.app_points(spark, folder), views.apps(spark, folder))
    return enriched.select("id", tag_fn.tags_text(F.col("tags")).alias("tags"))


def distinct_tag_sets(spark, folder):
    return enrich.distinct_tag_sets(views.pts(spark, folder)).select(tag_fn.tags_text(F.col("tags")).alias("tags"), "n_rows")


def _selected_props(spark, folder):
    props = views.props_map(spark, folder)
    other = F.create_map(F.lit("other"), F.lit("gizmo"), F.lit("app_type"), F.element_at("props", "app_type"), F.lit("team"), F.lit("t1"))
    return props.withColumn("second", other)


def tag_difference(spark, folder):
    rows = _selected_props(spark, folder)

    def text(difference):
        return F.array_join(F.sort_array(F.transform(difference, lambda e: F.concat(e["key"], F.lit("="), e["value"]))), ",")

    return rows.select(
        "id", text(tag_fn.tag_difference(F.col("props"), F.col("second"))).alias("only_first"),
        text(tag_fn.tag_difference(F.col("second"), F.col("props"))).alias("only_second"))


def merge_tags(spark, folder):
    rows = _selected_props(spark, folder)
    return rows.select(
        "id", tag_fn.tags_text(tag_fn.first_wins(F.col("props"), F.col("second"))).alias("first_wins"),
        tag_fn.tags_text(tag_fn.last_wins(F.col("props"), F.col("second"))).alias("last_wins"))


QUERIES = {
    "scan_points": scan_points,
    "sanitize_names": sanitize_names,
    "sanitize_tag_values": sanitize_tag_values,
    "format_numbers": format_numbers,
    "encode_metric_lines": encode_metric_lines,
    "encode_delta_lines": encode_delta_lines,
    "delta_names": delta_names,
    "default_source": default_source,
    "semver_number": semver_numbers,
    "epoch_columns": epoch_columns,
    "minute_bin": minute_bin,
    "app_point_tags": app_point_tags,
    "tags_by_pattern": tags_by_pattern,
    "validate_points": validate_points,
    "positive_deltas": positive_deltas,
    "route_entities": route_entities,
    "enrich_points": enrich_points,
    "distinct_tag_sets": distinct_tag_sets,
    "tag_difference": tag_difference,
    "merge_tags": merge_tags,
}

_TWO = "CASE WHEN length({0}) = 1 THEN '0' || {0} ELSE {0} END".format
_CLEAN_DOC = q.tag("text")
_APP_TAGS = ("'application=' || application || ',cluster=' || coalesce(cluster, 'none') || ',env=' || custom_env || "
             "{extra} ',service=' || service || ',shard=' || coalesce(shard, 'none')")

SQL = {
    "scan_points": with_views("pts", then="""
SELECT name, value, ts_ms, source, 'k=' || tag_k || ',type=' || tag_type AS tags FROM pts"""),
    "sanitize_names": f"""
SELECT md5(name) AS name_md5, CAST(length(name) AS INTEGER) AS name_length, count(DISTINCT raw) AS raw_names, count(*) AS n_rows
FROM (SELECT raw, {q.name('raw')} AS name FROM (SELECT text AS raw FROM documents UNION ALL SELECT url FROM pages)
  WHERE NOT {q.blank('raw')}) GROUP BY ALL""",
    "sanitize_tag_values": f"""
SELECT lang, source, count(*) AS n_values, count(*) FILTER (WHERE contains(clean, '\\"')) AS n_escaped,
  count(*) FILTER (WHERE length(clean) < length(text) + 2) AS n_trimmed,
  CAST(sum(length(clean)) AS BIGINT) AS clean_length, min(md5(clean)) AS least_md5
FROM (SELECT *, {_CLEAN_DOC} AS clean FROM documents) GROUP BY lang, source""",
    "format_numbers": f"""
SELECT o_orderkey, {q.number('o_totalprice')} AS plain, {q.number('floor(o_totalprice)')} AS whole,
  {q.number('o_totalprice * 1000003')} AS large, {q.number('-o_totalprice / 1e9')} AS small,
  {q.number('o_totalprice * 1e17')} AS huge, {q.number('o_totalprice / 1e12')} AS tiny FROM orders""",
    "encode_metric_lines": with_views("pts", then=f"""
SELECT id, {q.METRIC_LINE} AS line FROM pts WHERE ({q.POINT_REASON}) IS NULL"""),
    "encode_delta_lines": with_views("deltas", then=f"""
SELECT id, {q.name(q.delta('name'))} || ' ' || {q.number('value')} || {q.source()} || ' "k"=' || {q.tag('tag_k')} || ' "type"=' || {q.tag('tag_type')} AS line
FROM deltas WHERE value > 0"""),
    "delta_names": with_views("deltas", then=f"""
SELECT {q.delta('name')} AS name, count(DISTINCT deltas.name) AS raw_names, count(*) AS n_rows FROM deltas GROUP BY 1"""),
    "default_source": with_views("pts", then=f"""
SELECT CASE WHEN {q.blank('source')} THEN 'fallback-host' ELSE source END AS source, count(*) AS n_points FROM pts GROUP BY 1"""),
    "semver_number": with_views("versions", then=f"""
SELECT version, count(*) AS n_parts, coalesce(CASE WHEN m[1] <> '' THEN TRY_CAST(m[1] || '.' || {_TWO('m[2]')} || {_TWO('m[3]')} AS DOUBLE) END, 0.0) AS number
FROM (SELECT version, [regexp_extract(version, '([0-9]+)\\.(\\d+)\\.(\\d+)', 1),
  regexp_extract(version, '([0-9]+)\\.(\\d+)\\.(\\d+)', 2), regexp_extract(version, '([0-9]+)\\.(\\d+)\\.(\\d+)', 3)] AS m
  FROM versions) GROUP BY version, m"""),
    "epoch_columns": """
SELECT event_id, epoch_us(ts) // 1000 AS ms, epoch_us(ts) AS us, epoch_us(ts) - epoch_us(date_trunc('day', ts)) AS day_us FROM events""",
    "minute_bin": with_views("pts", then=f"""
SELECT granularity, event_ms // width * width AS start_ms, count(*) AS n_points
FROM pts, (VALUES ('!M', 60000), ('!H', 3600000), ('!D', 86400000)) AS g(granularity, width) GROUP BY ALL"""),
    "app_point_tags": with_views("apps", then=f"\nSELECT app_id, {_APP_TAGS.format(extra='')} AS tags FROM apps"),
    "tags_by_pattern": with_views("props_map", then=f"""
SELECT id, 'APP_brand=' || "APP_brand" || CASE WHEN {q.blank('"App_blank"')} THEN '' ELSE ',App_blank=' || "App_blank" END
  || ',app_type=' || app_type AS selected,
  CASE WHEN {q.blank('"App_blank"')} THEN '' ELSE 'size=' || "App_blank" END AS renamed FROM props_map"""),
    "validate_points": with_views("pts", then=f"""
SELECT coalesce({q.POINT_REASON}, 'valid') AS verdict, count(*) AS n_points, CAST(sum(id) AS BIGINT) AS id_sum FROM pts GROUP BY 1"""),
    "positive_deltas": with_views("deltas", then="\nSELECT id, name, round(value, 6) AS value FROM deltas WHERE value > 0"),
    "route_entities": """
SELECT 'points' AS entity, count(*) AS n, true AS routed FROM events
UNION ALL SELECT 'histograms', count(*), false FROM lineitem""",
    "enrich_points": with_views("pts", "apps", then=f"""
SELECT id, CASE WHEN application IS NULL THEN 'k=' || tag_k || ',type=' || tag_type
  ELSE {_APP_TAGS.format(extra="',k=' || tag_k || ")} || ',type=' || tag_type END AS tags FROM pts LEFT JOIN apps USING (app_id)"""),
    "distinct_tag_sets": with_views("pts", then="""
SELECT 'k=' || tag_k || ',type=' || tag_type AS tags, count(*) AS n_rows FROM pts GROUP BY 1"""),
    "tag_difference": with_views("props_map", then="""
SELECT id, 'APP_brand=' || "APP_brand" || ',App_blank=' || "App_blank" || CASE WHEN other = 'gizmo' THEN '' ELSE ',other=' || other END AS only_first,
  CASE WHEN other = 'gizmo' THEN '' ELSE 'other=gizmo,' END || 'team=t1' AS only_second FROM props_map"""),
    "merge_tags": with_views("props_map", then="""
SELECT id, 'APP_brand=' || "APP_brand" || ',App_blank=' || "App_blank" || ',app_type=' || app_type || ',other=' || other || ',team=t1' AS first_wins,
  'APP_brand=' || "APP_brand" || ',App_blank=' || "App_blank" || ',app_type=' || app_type || ',other=gizmo,team=t1' AS last_wins FROM props_map"""),
}
