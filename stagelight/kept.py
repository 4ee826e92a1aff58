"""Queries on graphs that lose venues, tables that merges rewrite in part, time series of rates, streams with state, page plans
in SQL and metrics of phases; each with its SQL."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stagelight import chain
from stagelight.catalogue import AS_OF, BASE, LOG, Tables, _log, _samples, query
from stagelight.lineage import kept, written
from stagelight.operators import catalog, metrics, normalize, pages, payloads, phases, quality, venue_parsers
from stagelight.plans import full
from stagelight.shipping import ship
from stagelight.sources.merged import MergedTable
from stagelight.streaming import state

# The graph: customers are venues, orders their events, parts artists


def _graph(spark, d) -> tuple[DataFrame, DataFrame]:
    """Nodes and edges. Who performs twice at an event has two edges."""
    t = Tables(spark, d)
    name = lambda p, c: F.concat(F.lit(p), F.col(c))
    venues = t.customer.select(name("v", "c_custkey").alias("id"), F.lit("venue").alias("label"), F.to_json(F.struct(F.concat(F.lit("hall-"), F.col("c_custkey")).alias("slug"))).alias("data"))
    shows = t.orders.select(name("e", "o_orderkey").alias("id"), F.lit("event").alias("label"), F.lit("{}").alias("data"))
    artists = t.part.select(name("a", "p_partkey").alias("id"), F.lit("artist").alias("label"), F.lit("{}").alias("data"))
    hosts = t.orders.select(name("v", "o_custkey").alias("source_id"), name("e", "o_orderkey").alias("target_id"), F.lit("hosts").alias("relation"))
    acts = t.lineitem.select(name("a", "l_partkey").alias("source_id"), name("e", "l_orderkey").alias("target_id"), F.lit("performs_at").alias("relation"))
    return venues.unionByName(shows).unionByName(artists), hosts.unionByName(acts)


def _without(spark, d, folder: str | None = None) -> tuple[DataFrame, DataFrame]:
    """All but every tenth venue go."""
    nodes, edges = _graph(spark, d)
    gone = Tables(spark, d).customer.where("c_custkey % 10 <> 3").select(F.concat(F.lit("v"), "c_custkey").alias("id"))
    return catalog.cascade(nodes, edges, gone, folder)


_CASCADE = """WITH hosts AS (SELECT o_custkey AS v, o_orderkey AS e FROM orders), acts AS (SELECT DISTINCT l_partkey AS a, l_orderkey AS e FROM lineitem),
gv AS (SELECT c_custkey AS v FROM customer WHERE c_custkey % 10 <> 3), ge AS (SELECT e FROM hosts WHERE v IN (SELECT v FROM gv)), held AS (SELECT e FROM hosts WHERE v NOT IN (SELECT v FROM gv)),
ga AS (SELECT DISTINCT a FROM acts WHERE e IN (SELECT e FROM ge) AND a NOT IN (SELECT a FROM acts WHERE e IN (SELECT e FROM held)))"""


@query(_CASCADE + """ SELECT 'v' || c_custkey AS id, 'venue' AS label FROM customer WHERE c_custkey NOT IN (SELECT v FROM gv) UNION ALL SELECT 'e' || o_orderkey, 'event' FROM orders WHERE o_orderkey NOT IN (SELECT e FROM ge) UNION ALL SELECT 'a' || p_partkey, 'artist' FROM part WHERE p_partkey NOT IN (SELECT a FROM ga)""")
def cascade_nodes(spark, d):
    """Nodes that stay when venues go in bulk: artists go with the last venue that holds them."""
    return _without(spark, d)[0].select("id", "label")


@query(_CASCADE + """ SELECT 'v' || v AS source_id, 'e' || e AS target_id, 'hosts' AS relation FROM hosts WHERE v NOT IN (SELECT v FROM gv) AND e NOT IN (SELECT e FROM ge)
UNION ALL SELECT 'a' || a, 'e' || e, 'performs_at' FROM acts WHERE e NOT IN (SELECT e FROM ge) AND a NOT IN (SELECT a FROM ga)""")
def cascade_edges(spark, d):
    def work(folder: str) -> DataFrame:
        left = _without(spark, d, folder)[1]
        rows = left.groupBy(*left.columns).agg(F.count("*").alias("n"))  # only acts are made one
        return rows.withColumn("n", F.explode(F.array_repeat(F.lit(1), F.when(F.col("relation") == "hosts", F.col("n").cast("int")).otherwise(1)))).drop("n")

    return kept(spark, "cascade", work)


# Stored tables


@query("""SELECT p_partkey AS id, CASE WHEN p_partkey % 4 = 0 THEN upper(p_name) ELSE p_name END AS name, CASE WHEN p_partkey % 3 = 0 THEN 'second' ELSE 'first' END AS created_at FROM part WHERE p_partkey % 5 <> 0""")
def merged_table(spark, d):
    """A stored table after two merges and a deletion, each of which rewrote only partitions with changes."""
    part = Tables(spark, d).part
    row = lambda df, name, when: df.select(F.col("p_partkey").alias("id"), F.expr(name).alias("name"), F.lit(when).alias("created_at"))

    def work(folder: str) -> DataFrame:
        table = MergedTable(spark, folder, "id long, name string, created_at string", ["id"], buckets=16, keep=("created_at",))
        table.upsert(row(part.where("p_partkey % 3 <> 0"), "p_name", "first"))
        table.upsert(row(part, "if(p_partkey % 4 = 0, upper(p_name), p_name)", "second"))
        table.delete(part.where("p_partkey % 5 = 0").select(F.col("p_partkey").alias("id")))
        return table.read()

    return kept(spark, "merged", work)


@query("""SELECT DISTINCT 'v' || o_custkey AS source_id, 'e' || o_orderkey AS target_id, 'hosts' AS relation, CASE WHEN o_orderkey % 2 = 0 THEN o_orderstatus ELSE 'new' END AS data FROM orders""")
def merged_edges(spark, d):
    """Edges of a stored graph by their three keys."""
    o = Tables(spark, d).orders
    row = lambda df, data: df.select(F.concat(F.lit("v"), "o_custkey").alias("source_id"), F.concat(F.lit("e"), "o_orderkey").alias("target_id"), F.lit("hosts").alias("relation"), data.alias("data"))

    def work(folder: str) -> DataFrame:
        table = MergedTable(spark, folder, "source_id string, target_id string, relation string, data string", ["source_id", "target_id", "relation"], buckets=16)
        table.upsert(row(o, F.col("o_orderstatus")))
        table.upsert(row(o.where("o_orderkey % 2 = 1"), F.lit("new")))
        return table.read()

    return kept(spark, "merged", work)


# Time series


@query("""WITH b(le) AS (VALUES (1e-1), (5e-1), (1e0), (25e-1), (5e0), (1e1), (CAST('inf' AS DOUBLE))),
m AS (SELECT event_type AS name, date_trunc('minute', ts) AS ts, le, count_if(value <= le) AS n FROM events, b GROUP BY ALL),
c AS (SELECT name, le, ts, n, row_number() OVER (PARTITION BY name, le ORDER BY ts) AS i FROM m), g AS (SELECT le, ts, CASE WHEN i = 1 THEN 0 ELSE n END AS gain FROM c),
w AS (SELECT le, unnest(generate_series(ts - INTERVAL 4 MINUTE, ts, INTERVAL 1 MINUTE)) AS window_start, gain FROM g), r AS (SELECT window_start, le, sum(gain) / 300e0 AS n FROM w GROUP BY ALL),
x AS (SELECT window_start, q, le, n, coalesce(lag(le) OVER o, 0) AS low, coalesce(lag(n) OVER o, 0) AS under, q * max(n) OVER (PARTITION BY window_start, q) AS k FROM r, (VALUES (5e-1), (95e-2), (99e-2)) t(q) WINDOW o AS (PARTITION BY window_start, q ORDER BY le))
SELECT window_start, q AS share, round(CASE WHEN le = CAST('inf' AS DOUBLE) THEN low ELSE low + (le - low) * (k - under) / nullif(n - under, 0) END, 6) AS quantile FROM x WHERE n > 0 AND n >= k - 1e-12 QUALIFY row_number() OVER (PARTITION BY window_start, q ORDER BY le) = 1""")
def rate_quantiles(spark, d):
    """Quantiles of what came in within each five minutes, from rates of bucket counters over all names."""
    counters = metrics.bucket_counters(_samples(spark, d), ["name"])
    return metrics.rate_quantiles(counters, []).select("window_start", "share", F.round("quantile", 6).alias("quantile"))


# Streams


@query(f"WITH {LOG} SELECT envelope_id, CASE WHEN f <> envelope_id THEN f END AS dedupe_of, CASE WHEN f = envelope_id THEN 'ref:' || envelope_id END AS payload_ref FROM tagged")
def envelopes_tagged_in_order(spark, d):
    """The log as a stream whose rows come out of order, tagged as the whole log is."""
    later = F.col("accepted_at") + F.expr("interval 1 day")  # the log begins at the epoch, which is where watermarks begin
    log = _log(spark, d).select("envelope_id", "idempotency_key", later.alias("accepted_at"), "payload_ref")

    def work(folder: str) -> DataFrame:
        # four batches by turns, then two of a key of their own that move the watermark beyond all
        log.withColumn("batch", F.pmod(F.xxhash64("envelope_id"), F.lit(4))).write.partitionBy("batch").parquet(f"{folder}/log")
        for i in (4, 5):
            spark.createDataFrame([(f"end{i}", "end", datetime(2196 + i, 1, 1), None)], log.schema).write.parquet(f"{folder}/log/batch={i}")
        source = spark.readStream.schema(f"{log.schema.simpleString()[7:-1].replace(':', ' ')}, batch int").option("maxFilesPerTrigger", 64).parquet(f"{folder}/log")
        tagged = state.tag_in_order(source, "36500 days")
        tagged.writeStream.format("parquet").option("path", f"{folder}/out").option("checkpointLocation", f"{folder}/ck").trigger(availableNow=True).start().awaitTermination()
        return spark.read.parquet(f"{folder}/out").where("idempotency_key <> 'end'").select("envelope_id", "dedupe_of", "payload_ref")

    return kept(spark, "stream", work)


# Page plans in SQL


@query(f"""WITH o AS (SELECT *, {chain._HEADED_DAY} AS day FROM orders), found AS (
SELECT 'kexp' AS source_id, 'Show & ' || o_orderkey AS title FROM orders WHERE o_orderkey % 7 > 1 UNION ALL SELECT 'sea_monster', 'T' || o_orderkey FROM orders UNION ALL SELECT 'darrells_tavern', t || o_orderkey FROM o, (VALUES ('Act '), ('Guest ')) v(t) WHERE day IS NOT NULL
UNION ALL SELECT 'barboza', 'Main ' || o_orderkey FROM orders UNION ALL SELECT 'neumos', 'Main ' || o_orderkey FROM orders) SELECT source_id, title, count(*) AS n FROM found GROUP BY ALL""")
def page_plans_in_sql(spark, d):
    """All five page plans by LATERAL parse_page."""
    pages.register_sql(spark)
    plans = {chain.RADIO: "kexp_html_v1", chain.WARMUP: "wix_warmup_v1", chain.HEADED: "darrells_html_v1", chain.BARBOZA: "barboza_html_v1", chain.NEUMOS: "neumos_html_v1"}
    named = F.create_map(*[F.lit(x) for kind, plan in plans.items() for x in (kind.source, plan)])
    given = chain._documents(Tables(spark, d).orders, *plans).select("source_id", named[F.col("source_id")].alias("plan"), F.col("payload").alias("html"))
    found = spark.sql("SELECT p.source_id, j.title FROM {given} p, LATERAL parse_page(p.html, p.plan, to_date(:day)) t, LATERAL json_tuple(t.record, 'title') AS j(title)", {"day": AS_OF.isoformat()}, given=given)
    return found.where("title is not null").groupBy("source_id", "title").agg(F.count("*").alias("n"))


# Phases


@query(chain.RECORDS + """, a AS (SELECT count(*) AS n FROM (SELECT DISTINCT source_id, name FROM named)), e AS (SELECT count(*) AS n, count_if(day IS NULL) AS undated, count_if(title = 'Open Mic') AS open FROM r)
SELECT 'parser' AS phase, 'rows' AS name, (SELECT count(*) FROM orders) AS value UNION ALL SELECT 'normalize', 'rows', n FROM e UNION ALL SELECT 'normalize', 'undated', undated FROM e UNION ALL SELECT 'normalize', 'open_mics', open FROM e
UNION ALL SELECT 'normalize', 'artists', n FROM a UNION ALL SELECT 'enrich', 'rows', n FROM e UNION ALL SELECT 'enrich', 'to_place', (SELECT count(*) FROM r WHERE source_id NOT IN ('neumos', 'conor_byrne')) FROM e""")
def phases_observed(spark, d):
    """Counters of a run's phases, observed while its tables were made."""
    run = phases.Phases("run")

    def work(folder: str) -> DataFrame:
        parsed = written(run.watch(chain._records(spark, d), "parser"), f"{folder}/parsed")
        tables = normalize.tables(parsed, AS_OF)
        events = written(run.watch(tables["event"], "normalize", {"undated": F.size("warnings") > 0, "open_mics": F.col("title") == "Open Mic"}), f"{folder}/events")
        artists = written(run.watch(tables["artist"], "normalize", {"artists": F.lit(True)}), f"{folder}/artists")
        out = full.assessed(tables | {"event": events, "artist": artists}, AS_OF)["event"]
        written(run.watch(out, "enrich", {"to_place": F.exists("issues", lambda i: i["field"] == "venue_id")}), f"{folder}/assessed")
        return run.collected(spark)

    seen = kept(spark, "phases", work).where("kind = 'counter'")
    rows = seen.where("name <> 'rows'").unionByName(seen.where("name = 'rows'").groupBy("run", "phase", "name", "kind", "le", "at").agg(F.max("value").alias("value")).select(*seen.columns))
    return rows.select("phase", "name", F.col("value").cast("long").alias("value"))


# Small ones


@query("SELECT p_partkey AS id, CASE WHEN p_partkey % 9 = 8 THEN 'elsewhere' ELSE 'crawler_' || s END AS api, CASE WHEN p_partkey % 9 = 8 THEN 'elsewhere' WHEN s = 'sunset_tavern' THEN 'crawler_sunset_tavern' ELSE s END AS back FROM (SELECT p_partkey, ['blue_moon', 'sea_monster', 'darrells_tavern', 'kexp', 'barboza', 'neumos', 'conor_byrne', 'sunset_tavern', ''][p_partkey % 9 + 1] AS s FROM part)")
def api_names(spark, d):
    """All eight names that sources go by, and one that stands for itself, there and back."""
    names = F.array(*[F.lit(x) for x in (*payloads.API_NAMES, "elsewhere")])
    rows = Tables(spark, d).part.select(F.col("p_partkey").alias("id"), F.get(names, (F.col("p_partkey") % 9).cast("int")).alias("s"))
    rows = rows.select("id", payloads.api_name(F.col("s")).alias("api"))
    return rows.select("id", "api", payloads.source_of(F.col("api")).alias("back"))


@query(BASE + " SELECT CAST(venue_id AS VARCHAR) || '_' || CAST(event_day AS VARCHAR) AS signature, count(*) AS n FROM shows GROUP BY venue_id, event_day HAVING count(*) > 1")
def repeated_signatures(spark, d):
    """Which (venue, day) pairs more than one event has."""
    return catalog.repeated_signatures(Tables(spark, d).shows)


@query("""SELECT CAST(o_orderkey AS VARCHAR) AS envelope_id, CASE WHEN o_orderkey % 7 <> 0 AND o_orderkey % 11 <> 0 THEN 'show-' || o_orderkey END AS event_api_id, CASE WHEN o_orderkey % 7 <> 0 AND o_orderkey % 11 <> 0 THEN 'KEXP' END AS venue_name,
CASE WHEN o_orderkey % 7 <> 0 AND o_orderkey % 11 <> 0 THEN CAST(o_orderdate AS DATE) END AS event_day, CASE WHEN o_orderkey % 7 <> 0 AND o_orderkey % 11 <> 0 THEN '13:00:00' END AS start_time, CASE WHEN o_orderkey % 7 <> 0 AND o_orderkey % 11 <> 0 THEN 'https://x.example/' || o_custkey END AS event_url,
CASE WHEN o_orderkey % 7 <> 0 AND o_orderkey % 11 <> 0 AND o_orderkey % 3 = 0 THEN 'broadcast only' END AS skipped, CASE WHEN o_orderkey % 7 = 0 THEN 'date not found' WHEN o_orderkey % 11 = 0 THEN 'day not understood' END AS error FROM orders""")
def crawled_listings(spark, d):
    """Records of the archived crawler, with its own fields, some of them without a day or with one that is none."""
    k, day = F.col("o_orderkey"), F.date_format("o_orderdate", "yyyy-MM-dd")
    title = F.concat(F.lit("Act LIVE on KEXP"), F.when(k % 3 == 0, "").otherwise(" (OPEN TO THE PUBLIC)"))
    record = F.to_json(F.struct(F.concat(F.lit("show-"), k).alias("id"), title.alias("title"), F.when(k % 7 == 0, None).when(k % 11 == 0, "soon").otherwise(day).alias("date"), F.lit("13:00:00").alias("start_time"), F.concat(F.lit("https://x.example/"), F.col("o_custkey")).alias("url")))
    rows = Tables(spark, d).orders.select(F.lit("kexp").alias("source_id"), k.cast("string").alias("envelope_id"), record.alias("record"))
    return venue_parsers.crawled_listings(rows).drop("source_id", "title", "description")


@query("""SELECT CAST(o_custkey AS VARCHAR) AS envelope_id, count(*) FILTER (o_orderkey % 3 <> 0) AS n, count(*) FILTER (o_orderkey % 3 = 1) AS titled FROM orders GROUP BY 1 HAVING count(*) FILTER (o_orderkey % 3 <> 0) > 0
UNION ALL SELECT CAST(o_custkey AS VARCHAR), 1, 0 FROM orders GROUP BY 1 HAVING count(*) FILTER (o_orderkey % 3 <> 0) = 0""")
def ticket_items_with_title_or_day(spark, d):
    """Items are kept if they have a title or a day; pages without any such item give one row."""

    def item(k: Column, day: Column) -> Column:
        inside = F.when(k % 3 == 1, F.concat(F.lit('<h3 class="title"><a>Act '), k, F.lit("</a></h3>"))).when(k % 3 == 2, F.lit('<span class="m-date__month">May</span><span class="m-date__day">5</span>')).otherwise('<div class="meta"><span class="age">21+</span></div>')
        return F.concat(F.lit('<div class="eventItem">'), inside, F.lit("</div>"))

    html = chain._documents(Tables(spark, d).orders, chain.BARBOZA._replace(item=item)).withColumnRenamed("payload", "html")
    ship(spark)
    found = pages.parse_pages(html, "barboza_html_v1", AS_OF)
    return found.groupBy("envelope_id").agg(F.count("*").alias("n"), F.count_if(F.get_json_object("record", "$.title").isNotNull()).alias("titled"))


@query(chain.RECORDS + """ SELECT source_id, count(*) AS n, count_if(day IS NULL) AS noted, round(sum(ec - CASE WHEN day IS NULL THEN 1e-2 ELSE 0 END - CASE WHEN source_id NOT IN ('neumos', 'conor_byrne') THEN 1e-2 ELSE 0 END
  - CASE WHEN coalesce(day, DATE '1999-06-01') - DATE '1999-06-01' > 365 OR coalesce(day, DATE '1999-06-01') - DATE '1999-06-01' < -30 THEN 5e-2 ELSE 0 END), 4) AS total FROM r GROUP BY 1""")
def quality_with_warnings(spark, d):
    """Warnings of normalization lower the score of events as information does."""
    e = normalize.events(chain._records(spark, d), AS_OF)
    issues = quality.event_issues(F.col("title"), F.col("event_day"), F.col("venue_id"), F.lit(AS_OF).cast("date"))
    rows = quality.assess(e, issues, warnings="warnings")
    noted = F.exists("issues", lambda i: i["issue_type"] == "Normalization")
    return rows.groupBy("source_id").agg(F.count("*").alias("n"), F.count_if(noted).alias("noted"), F.round(F.sum("quality_score"), 4).alias("total"))


@query(BASE + "SELECT * FROM shows ORDER BY event_day, id OFFSET 1000")
def events_after_an_offset(spark, d):
    """All events but the first thousand, without a limit."""
    return Tables(spark, d).listings().all_events(offset=1000)
