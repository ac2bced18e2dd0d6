"""Sampling, pick, bucket and report queries on stand-in tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from gleanworks.functions import arrays as ar
from gleanworks.functions import scalars as sc
from gleanworks.operators import curation as cu
from gleanworks.operators import evaluation as ev
from gleanworks.operators import sampling as sa
from gleanworks.plans.catalog import query
from gleanworks.plans.curation import LEADERS, docs, fingerprints, in_list, langs, order_lines
from gleanworks.plans.evaluation import CLASSES, CURVE, PREDS_SQL, logits, preds
from gleanworks.session import table

_KEY = "CAST('0x' || substr(md5({}), 1, 8) AS BIGINT)"


def _key(seed: int, *columns: str) -> str:
    return _KEY.format(" || ':' || ".join([f"'{seed}'", *columns]))


@query("seeded_head", f"SELECT doc_id, lang FROM documents ORDER BY {_key(42, 'doc_id')}, doc_id LIMIT 30")
def seeded_head(spark, sf_dir):
    return sa.seeded_head(table(spark, sf_dir, "documents").select("doc_id", "lang"), 30, 42, "doc_id")


@query("ordered_subset", f"SELECT doc_id, n_chars FROM (SELECT * FROM documents ORDER BY {_key(0, 'doc_id')}, doc_id LIMIT 50) ORDER BY doc_id")
def ordered_subset(spark, sf_dir):
    return sa.ordered_subset(table(spark, sf_dir, "documents").select("doc_id", "n_chars"), 50, 0, "doc_id")


@query("evenly_spaced", """WITH r AS (SELECT event_id, row_number() OVER (ORDER BY event_id) - 1 AS rn, count(*) OVER () AS n FROM events)
SELECT event_id FROM r WHERE rn IN (SELECT CAST(trunc(i * (n - 1) / 15) AS BIGINT) FROM (SELECT UNNEST(range(16)) AS i))""")
def evenly_spaced(spark, sf_dir):
    return sa.evenly_spaced(table(spark, sf_dir, "events").select("event_id"), "event_id", 16)


@query("balanced_replicates", f"""WITH c AS (SELECT lang, count(*) AS n FROM documents GROUP BY 1), r AS (SELECT lang, CAST(sum(n) OVER () AS DOUBLE) / count(*) OVER () / n AS rate FROM c)
SELECT doc_id, lang, CAST(floor(rate) + CASE WHEN {_key(7, 'doc_id')} / 4294967296.0::DOUBLE < rate - floor(rate) THEN 1 ELSE 0 END AS BIGINT) AS copies FROM documents JOIN r USING (lang)""")
def balanced_replicates(spark, sf_dir):
    return sa.balanced_replicates(table(spark, sf_dir, "documents").select("doc_id", "lang"), "lang", "doc_id", 7)


@query("drawn_copies", """WITH c AS (SELECT lang, count(*) AS n, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS class FROM documents GROUP BY lang),
d AS (SELECT md5('11:' || i) AS m FROM (SELECT unnest(range((SELECT count(*) FROM documents))) AS i)),
t AS (SELECT lang, CAST('0x' || substr(m, 16, 15) AS BIGINT) % n AS at, count(*) AS copies FROM d JOIN c ON c.class = CAST('0x' || substr(m, 1, 15) AS BIGINT) % (SELECT count(*) FROM c) GROUP BY 1, 2),
r AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS at FROM documents)
SELECT doc_id, r.lang, coalesce(copies, 0) AS copies FROM r LEFT JOIN t ON t.at = r.at AND t.lang IS NOT DISTINCT FROM r.lang""")
def drawn_copies(spark, sf_dir):
    """Sampling with replacement, every language alike, as many draws as documents."""
    return sa.drawn_copies(table(spark, sf_dir, "documents").select("doc_id", "lang"), "lang", "doc_id", 11)


_PIC = "CASE WHEN p_partkey % 7 = 0 THEN 'inat_' ELSE 'web_' END || p_partkey"


@query("reference_picks", f"""SELECT p_brand, name FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY CASE WHEN starts_with(name, 'web_') THEN 1 ELSE 0 END, {_key(3, 'p_brand', 'name')}, name) AS nth
  FROM (SELECT p_brand, {_PIC} AS name FROM part)) WHERE nth <= 6""")
def reference_picks(spark, sf_dir):
    name = F.concat(F.when(F.col("p_partkey") % 7 == 0, "inat_").otherwise("web_"), F.col("p_partkey").cast("string"))
    return sa.reference_picks(table(spark, sf_dir, "part").select("p_brand", name.alias("name")), 6, 3, "p_brand", "name")


@query("corrupt_row_replacement", f"""WITH g AS (SELECT lang, doc_id AS used, row_number() OVER (PARTITION BY lang ORDER BY doc_id) - 1 AS at, count(*) OVER (PARTITION BY lang) AS n FROM documents WHERE doc_id % 11 <> 0),
s AS (SELECT DISTINCT lang, n FROM g), b AS (SELECT lang, doc_id, {_key(5, 'doc_id')} % n AS at FROM documents LEFT JOIN s USING (lang) WHERE doc_id % 11 = 0)
SELECT lang, used AS doc_id, used FROM g UNION ALL SELECT b.lang, doc_id, used FROM b LEFT JOIN g ON g.lang = b.lang AND g.at = b.at""")
def corrupt_row_replacement(spark, sf_dir):
    return sa.replaced_rows(table(spark, sf_dir, "documents").select("lang", "doc_id"), "lang", "doc_id", "doc_id % 11 <> 0", 5)


#: (place, bucket, keywords): the first bucket wins.
BUCKETS = ((0, "deals", ("click", "purchase")), (1, "looks", ("view", "click")), (2, "other_fish", ("none",)))


def buckets(spark):
    rows = [F.struct(F.lit(p).alias("place"), F.lit(b).alias("bucket"), F.array(*map(F.lit, k)).alias("keywords")) for p, b, k in BUCKETS]
    return spark.range(1).select(F.inline(F.array(*rows)))


_BUCKETS = "(VALUES " + ", ".join(f"({p}, '{b}', '{w}')" for p, b, k in BUCKETS for w in k) + ") b(place, bucket, word)"


@query("bucket_lookup", f"SELECT event_id, event_type, (SELECT arg_min(bucket, place) FROM {_BUCKETS} WHERE word = event_type) AS bucket FROM events")
def bucket_lookup(spark, sf_dir):
    return sa.bucket_of(table(spark, sf_dir, "events").select("event_id", "event_type"), "event_type", buckets(spark))


@query("bucket_holdings", f"""SELECT bucket, count(k) AS n FROM (SELECT DISTINCT bucket FROM {_BUCKETS}) LEFT JOIN
  (SELECT CASE WHEN event_id % 5 = 0 THEN 'other_fish' ELSE CASE event_type WHEN 'click' THEN 'deals' WHEN 'view' THEN 'looks' END END AS k FROM events WHERE user_id % 2 = 0) ON k = bucket GROUP BY bucket""")
def bucket_holdings(spark, sf_dir):
    log = table(spark, sf_dir, "events").select(
        F.when(F.col("user_id") % 2 == 0, "other").otherwise("cod").alias("species"), F.when(F.col("event_id") % 5 == 0, "inaturalist").otherwise("web").alias("source"),
        F.when(F.col("event_type") == "click", "deals").when(F.col("event_type") == "view", "looks").alias("source_id"),
    )
    return sa.bucket_holdings(log, buckets(spark))


@query("quota_by_bucket", """WITH h AS (SELECT c_mktsegment AS segment, c_nationkey AS nation, count(*) AS have FROM customer GROUP BY 1, 2)
SELECT segment, nation, have, CASE WHEN greatest(0, CAST(floor(600 * 0.05) AS INT) - have) > 0 THEN CAST(greatest(5, ceil(greatest(0, CAST(floor(600 * 0.05) AS INT) - have) / 3)) AS INT) END AS per_keyword,
  CAST(have + greatest(5, floor(floor(600 * 0.05) / 4)) AS BIGINT) AS taxon_limit FROM h""")
def quota_by_bucket(spark, sf_dir):
    df = table(spark, sf_dir, "customer").groupBy(F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").alias("nation")).agg(F.count("*").alias("have"))
    share = sc.deficit_per_keyword(F.lit(600), 0.05, F.col("have"), F.lit(3))
    return df.withColumn("per_keyword", share).withColumn("taxon_limit", sc.taxon_limit(F.lit(600), 0.05, F.lit(4), F.col("have")))


@query("class_targets", """SELECT p_partkey, coalesce(CASE WHEN p_size % 9 = 0 THEN p_size * 10 END, CASE p_size % 4 WHEN 0 THEN 350 WHEN 1 THEN 600 WHEN 2 THEN 1000 END) AS target, p_size % 4 <> 3 AS fish,
  coalesce(CASE WHEN p_size % 5 > 0 THEN p_brand END, 'idx' || p_size) AS label FROM part""")
def class_targets(spark, sf_dir):
    kind = F.element_at(F.array(*map(F.lit, ("easy", "medium", "hard", "unknown"))), (F.col("p_size") % 4 + 1).cast("int"))
    habitat = F.when(F.col("p_size") % 4 == 3, "other").otherwise("sea")
    target = sc.target_of(F.when(F.col("p_size") % 9 == 0, F.col("p_size") * 10), kind)
    name = F.when(F.col("p_size") % 5 > 0, F.col("p_brand"))
    return table(spark, sf_dir, "part").select("p_partkey", target.alias("target"), sc.is_fish(habitat).alias("fish"), sc.class_text(name, F.col("p_size")).alias("label"))


_SPLIT_OF = "CASE doc_id % 10 WHEN 8 THEN 'val' WHEN 9 THEN 'test' ELSE 'train' END"


@query("split_flags", f"""WITH t AS (SELECT class, 300 AS target FROM (SELECT UNNEST([{in_list(('de', 'en', 'es', 'fr', 'it'))}]) AS class)),
c AS (SELECT lang AS class, count(*) FILTER (s = 'train') AS train, count(*) FILTER (s = 'val') AS val, count(*) FILTER (s = 'test') AS test, count(*) AS total FROM (SELECT lang, {_SPLIT_OF} AS s FROM documents) GROUP BY ROLLUP(lang))
SELECT class, coalesce(train, 0) AS train, coalesce(val, 0) AS val, coalesce(test, 0) AS test, coalesce(total, 0) AS total, coalesce(total, 0) < target * 0.5 AS low, coalesce(total, 0) = 0 AS empty FROM t LEFT JOIN c USING (class)
UNION ALL SELECT class, train, val, test, total, NULL, NULL FROM c WHERE class IS NULL""")
def split_flags(spark, sf_dir):
    m = F.col("doc_id") % 10
    df = docs(spark, sf_dir).withColumn("split", F.when(m == 8, "val").when(m == 9, "test").otherwise("train"))
    return cu.split_flags(df.select("class", "split"), langs(spark).withColumn("target", F.lit(300).cast("long")), ["train", "val", "test"])


@query("label_order_check", """WITH a AS (SELECT n_nationkey AS idx, n_name AS name FROM nation), b AS (SELECT idx, CASE WHEN idx = 4 THEN 'OTHER' ELSE name END AS name FROM a WHERE idx <> 7)
SELECT CAST(idx AS INT) AS idx, a.name AS model, b.name AS config FROM a FULL JOIN b USING (idx) WHERE a.name IS DISTINCT FROM b.name""")
def label_order_check(spark, sf_dir):
    """Two label lists compared by position; one has a changed name and a missing one."""
    model = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("int").alias("idx"), F.col("n_name").alias("name"))
    config = model.where("idx <> 7").withColumn("name", F.when(F.col("idx") == 4, "OTHER").otherwise(F.col("name")))
    out = sa.order_mismatches({"model": model, "config": config})
    return out.select("idx", F.try_element_at("names", F.lit("model")).alias("model"), F.try_element_at("names", F.lit("config")).alias("config"))


@query("prediction_table", PREDS_SQL + f"""SELECT 'split/c' || y || '/' || f AS path, f AS filename, CASE WHEN vec_id % 3 = 0 THEN 'inat' ELSE 'web' END AS source, 'c' || y AS "true", 'c' || pred AS pred,
  round(conf, 4) AS confidence, CAST(h1 AS INT) AS correct_top1, CAST(h3 AS INT) AS correct_top3 FROM (SELECT *, CASE WHEN vec_id % 3 = 0 THEN 'inat_' ELSE 'web_' END || vec_id || '.jpg' AS f FROM one)""")
def prediction_table(spark, sf_dir):
    names = ev.class_dim(spark, CLASSES).withColumn("name", F.concat(F.lit("c"), F.col("class").cast("string")))
    kind = F.when(F.col("id") % 3 == 0, "inat_").otherwise("web_")
    path = F.concat(F.lit("split/c"), F.col("y").cast("string"), F.lit("/"), kind, F.col("id").cast("string"), F.lit(".jpg"))
    return ev.prediction_table(preds(spark, sf_dir), names, path)


@query("metrics_document", PREDS_SQL + f"SELECT count(*) AS n, avg(h1) AS top1, (SELECT count(*) FROM classes) AS classes, {len(CURVE)} AS thresholds, least(50, count(*) FILTER (pred <> y)) AS cases FROM one")
def metrics_document(spark, sf_dir):
    """The metrics document, read back: its overall figures and the sizes of its parts."""
    doc = ev.metrics_document(preds(spark, sf_dir), ev.class_dim(spark, CLASSES), CURVE)
    schema = "overall struct<n:bigint,top1:double,top3:double>, per_class map<string,struct<support:bigint,recall:double>>, threshold_curve array<struct<t:double>>, worst_cases array<struct<id:bigint,conf:double>>"
    d = doc.select(F.from_json("document", schema).alias("d"))
    size = lambda c: F.size(f"d.{c}").cast("long")
    return d.select("d.overall.n", "d.overall.top1", size("per_class").alias("classes"), size("threshold_curve").cast("int").alias("thresholds"), size("worst_cases").alias("cases"))


@query("batch_totals", """SELECT CAST(sum(n) AS BIGINT) AS n, sum(loss * n) / sum(n) AS loss, CAST(sum(h1) AS DOUBLE) / sum(n) AS top1, CAST(sum(h3) AS DOUBLE) / sum(n) AS top3
FROM (SELECT CAST(l_linenumber AS DOUBLE) AS loss, CAST(l_quantity AS BIGINT) AS n, CAST(l_quantity AS BIGINT) // 2 AS h1, CAST(l_quantity AS BIGINT) - 1 AS h3 FROM lineitem)""")
def batch_totals(spark, sf_dir):
    n = F.col("l_quantity").cast("long")
    return ev.batch_totals(table(spark, sf_dir, "lineitem").select(F.col("l_linenumber").cast("double").alias("loss"), n.alias("size"), F.expr("CAST(l_quantity AS BIGINT) div 2").alias("hits1"), (n - 1).alias("hits3")))


@query("difference_summary", "SELECT CASE WHEN p_size > 25 THEN 'down' ELSE 'up' END AS scale, count(*) AS n, max(abs(p_size % 7 - 3)) AS largest, avg(abs(p_size % 7 - 3)) AS mean, count(*) FILTER (p_size % 7 = 3) AS zeros FROM part GROUP BY 1")
def difference_summary(spark, sf_dir):
    df = table(spark, sf_dir, "part").withColumn("scale", F.when(F.col("p_size") > 25, "down").otherwise("up"))
    return ev.difference_summary(df, "scale", F.col("p_size") % 7 - 3)


@query("output_parity", f"""WITH d AS (SELECT vec_id, list_transform(embedding[1:{CLASSES}], lambda x: CAST(x AS DOUBLE)) AS a, list_transform(embedding[1:{CLASSES}], lambda x: CAST(CAST(x AS DOUBLE) * 1000 AS BIGINT) / 1000.0) AS b FROM embeddings),
m AS (SELECT list_max(list_transform(range(1, {CLASSES + 1}), lambda i: abs(a[i] - b[i]))) AS d, list_position(a, list_max(a)) = list_position(b, list_max(b)) AS same FROM d)
SELECT count(*) AS n, round(max(d), 9) AS largest, count(*) FILTER (d > 0.0004) AS over, count(*) FILTER (same) AS same_top1 FROM m""")
def output_parity(spark, sf_dir):
    """Outputs against the same rounded to thousandths."""
    a = F.transform(F.slice("embedding", 1, CLASSES), lambda x: x.cast("double"))
    df = table(spark, sf_dir, "embeddings").select(a.alias("a")).withColumn("b", F.transform("a", lambda x: F.round(x * 1000).cast("long") / 1000.0))
    return ev.parity(df, "a", "b", 0.0004).withColumn("largest", ar.rounded(F.col("largest"), 9))


@query("normalised_plane", "SELECT vec_id, list_transform(embedding, lambda x: round((CAST(x AS DOUBLE) - 0.5 * 255) * (1 / (0.25 * 255)), 9)) AS plane FROM embeddings")
def normalised_plane(spark, sf_dir):
    x = F.transform("embedding", lambda v: v.cast("double"))
    return table(spark, sf_dir, "embeddings").select("vec_id", F.transform(ar.normalised(x, F.lit(0.5), F.lit(0.25)), lambda v: ar.rounded(v, 9)).alias("plane"))


@query("hamming_near_8", """WITH f AS (SELECT p_partkey AS id, p_size AS class, CAST('0x' || substr(md5('' || (p_partkey // 4)), 1, 15) AS BIGINT) AS h0 FROM part),
h AS (SELECT id, class, xor(h0, CAST((id % 4) * 4097 AS BIGINT)) AS h FROM f)
SELECT a.id AS a, b.id AS b, CAST(bit_count(xor(a.h, b.h)) AS INT) AS distance FROM h a JOIN h b ON a.id < b.id AND a.class <> b.class WHERE bit_count(xor(a.h, b.h)) <= 8""")
def hamming_near_8(spark, sf_dir):
    """Near fingerprints at the usual threshold, by bands."""
    h0 = F.conv(F.substring(F.md5(F.floor(F.col("p_partkey") / 4).cast("string")), 1, 15), 16, 10).cast("long")
    h = h0.bitwiseXOR((F.col("p_partkey") % 4 * 4097).cast("long"))
    return cu.hamming_pairs(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_size").alias("class"), h.alias("h")), 8)


@query("dedup_near_funnel", LEADERS + """, b AS (SELECT class, CASE WHEN row_number() OVER (PARTITION BY class, leader ORDER BY CASE WHEN id % 3 = 0 THEN 0 ELSE 1 END, id % 97 DESC, CASE WHEN id % 3 = 0 THEN 'inat_' ELSE 'web_' END || id) = 1 THEN 'kept' ELSE 'near' END AS stage FROM w)
SELECT class, count(*) AS raw, count(*) FILTER (stage = 'near') AS near, count(*) FILTER (stage = 'kept') AS kept FROM b GROUP BY ROLLUP(class)""")
def dedup_near_funnel(spark, sf_dir):
    """Leader groups of each class, the best of each kept, the rest near copies; counts by class."""
    df = fingerprints(spark, sf_dir).withColumn("name", F.concat(F.when(F.col("id") % 3 == 0, "inat_").otherwise("web_"), F.col("id").cast("string")))
    return cu.funnel(cu.near_stage(df, 20, F.col("id") % 97, "name"), "stage", ("near", "kept"))


@query("group_split_strata")
def group_split_strata(spark, sf_dir):
    """As group_split_exact, with strata for one class."""
    df = order_lines(spark, sf_dir)
    return cu.group_split(df.withColumn("stratum", F.when(F.col("class") == "5-LOW", F.substring("name", 1, 4))))
