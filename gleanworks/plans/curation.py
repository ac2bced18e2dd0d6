"""Curation queries on stand-in tables: a class is a language, label or priority, a file is a row."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from gleanworks.functions import scalars as sc
from gleanworks.operators import curation as cu
from gleanworks.plans.catalog import query
from gleanworks.session import table

LANGS = ("de", "en", "es", "fr", "it")
SPLITS = ("train", "val", "test")


def langs(spark):
    return spark.range(1).select(F.explode(F.array(*map(F.lit, LANGS))).alias("class"))


def docs(spark, sf_dir):
    return table(spark, sf_dir, "documents").withColumnRenamed("lang", "class")


def in_list(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


_LANGS = f"(SELECT UNNEST([{in_list(LANGS)}]) AS class)"
#: A name for each document: prefix and suffix by its id.
_NAME = "CASE doc_id % 3 WHEN 0 THEN 'inat_' WHEN 1 THEN 'web_' ELSE 'x' END || doc_id || CASE doc_id % 5 WHEN 0 THEN '.JPG' WHEN 1 THEN '.png' WHEN 2 THEN '.gif' WHEN 3 THEN '.webp' ELSE '' END"


def doc_name():
    head = F.when(F.col("doc_id") % 3 == 0, "inat_").when(F.col("doc_id") % 3 == 1, "web_").otherwise("x")
    m = F.col("doc_id") % 5
    return F.concat(head, F.col("doc_id").cast("string"), F.when(m == 0, ".JPG").when(m == 1, ".png").when(m == 2, ".gif").when(m == 3, ".webp").otherwise(""))


@query("class_counts_zero_fill", f"SELECT class, count(doc_id) AS n FROM {_LANGS} LEFT JOIN documents ON lang = class GROUP BY class")
def class_counts_zero_fill(spark, sf_dir):
    return cu.counts_by_class(docs(spark, sf_dir), langs(spark))


_BUCKET = "CAST('0x' || substr(md5('42:' || {} || ':' || {}), 1, 8) AS BIGINT) % 100"
_SPLIT = "CASE WHEN b < 70 THEN 'train' WHEN b < 85 THEN 'val' ELSE 'test' END"


@query("split_pivot_totals", f"""WITH s AS (SELECT lang, {_SPLIT} AS split FROM (SELECT lang, {_BUCKET.format('lang', 'doc_id')} AS b FROM documents))
SELECT lang AS class, {', '.join(f"count(*) FILTER (split = '{x}') AS {x}" for x in SPLITS)}, count(*) AS total FROM s GROUP BY ROLLUP(lang)""")
def split_pivot_totals(spark, sf_dir):
    df = docs(spark, sf_dir).withColumn("split", cu.hashed_split(F.col("doc_id"), F.col("class")))
    return cu.split_table(df, list(SPLITS))


@query("suffix_source_class", f"""WITH n AS (SELECT lang AS class, doc_id, {_NAME} AS name FROM documents)
SELECT class, name, CASE WHEN starts_with(name, 'inat_') THEN 'inat' WHEN starts_with(name, 'web_') THEN 'web' ELSE 'other' END AS source FROM n
WHERE nullif(lower(regexp_extract(name, '(\\.[^./]+)$', 1)), '') IN ({in_list(sc.SUFFIXES)})""")
def suffix_source_class(spark, sf_dir):
    df = docs(spark, sf_dir).select("class", doc_name().alias("name"))
    return df.where(sc.suffix_of(F.col("name")).isin(*sc.SUFFIXES)).withColumn("source", sc.source_of(F.col("name")))


@query("byte_gate_reason", """WITH s AS (SELECT doc_id, strlen(text) * 4 AS n, CASE WHEN doc_id % 50 = 7 THEN NULL ELSE 190 + doc_id % 400 END AS w, 190 + (doc_id * 7) % 1100 AS h FROM documents)
SELECT doc_id, CASE WHEN n < 6144 THEN 'too_small_bytes' WHEN n > 12582912 THEN 'too_large_bytes' WHEN w IS NULL THEN 'decode_failed' WHEN least(w, h) < 200 THEN 'small_' || w || 'x' || h
  WHEN greatest(w, h) / greatest(1, least(w, h)) > 4.0 THEN 'extreme_aspect' ELSE 'ok' END AS reason FROM s""")
def byte_gate_reason(spark, sf_dir):
    i = F.col("doc_id")
    w, h = F.when(i % 50 != 7, 190 + i % 400), 190 + (i * 7) % 1100
    return table(spark, sf_dir, "documents").select("doc_id", sc.gate_reason(F.octet_length("text") * 4, w, h).alias("reason"))


_LINE = "l_orderkey || '_' || l_linenumber || l_partkey || l_suppkey"
_FILE = f"CASE l_linenumber % 3 WHEN 0 THEN 'web_' || md5({_LINE}) ELSE 'inat_' || {_LINE} END || '.jpg'"


def line_files(spark, sf_dir):
    line = F.concat(F.col("l_orderkey").cast("string"), F.lit("_"), *(F.col(c).cast("string") for c in ("l_linenumber", "l_partkey", "l_suppkey")))
    name = F.concat(F.when(F.col("l_linenumber") % 3 == 0, F.concat(F.lit("web_"), F.md5(line))).otherwise(F.concat(F.lit("inat_"), line)), F.lit(".jpg"))
    return table(spark, sf_dir, "lineitem").withColumn("name", name)


@query("inat_regex_ids", f"SELECT name, nullif(regexp_extract(name, '^inat_([0-9]+)_', 1), '') AS observation, nullif(regexp_extract(name, '^inat_[0-9]+_([0-9]+)\\.', 1), '') AS photo FROM (SELECT {_FILE} AS name FROM lineitem)")
def inat_regex_ids(spark, sf_dir):
    return line_files(spark, sf_dir).select("name", sc.observation_of(F.col("name")).alias("observation"), sc.photo_of(F.col("name")).alias("photo"))


@query("leak_group_key", f"""SELECT name, coalesce('obs' || nullif(regexp_extract(name, '^inat_([0-9]+)_', 1), ''), 'p' || g, 'f' || name) AS grp
FROM (SELECT {_FILE} AS name, l_suppkey FROM lineitem) LEFT JOIN (SELECT s_suppkey, s_nationkey AS g FROM supplier WHERE s_suppkey % 2 = 0) ON l_suppkey = s_suppkey""")
def leak_group_key(spark, sf_dir):
    groups = table(spark, sf_dir, "supplier").where("s_suppkey % 2 = 0").select(F.col("s_suppkey").alias("l_suppkey"), F.col("s_nationkey").alias("g"))
    df = line_files(spark, sf_dir).select("name", "l_suppkey").join(groups, "l_suppkey", "left")
    return df.select("name", sc.leak_group(F.col("name"), F.col("g")).alias("grp"))


@query("url_hash_filename", "SELECT page_id, 'web_' || substr(sha1(url), 1, 12) || '.jpg' AS filename FROM pages")
def url_hash_filename(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", sc.url_filename(F.col("url")).alias("filename"))


@query("url_token_rewrite", "SELECT page_id, CASE WHEN contains(url, '/m.') THEN regexp_replace(url, '/m\\.', '/large.') WHEN contains(url, '/blog.') THEN regexp_replace(url, '/blog\\.', '/large.') ELSE url END AS url FROM pages")
def url_token_rewrite(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", sc.resized_url(F.col("url"), "large", ("m", "blog")).alias("url"))


_CODE = "CASE event_type WHEN 'click' THEN 'CC-BY' WHEN 'view' THEN 'cc0' WHEN 'purchase' THEN '' ELSE event_type END"


@query("licence_filter", f"SELECT event_id, coalesce(nullif(code, ''), 'all-rights-reserved') AS licence, left(props, 200) AS author FROM (SELECT *, {_CODE} AS code FROM events) WHERE lower(code) IN ({in_list(sc.LICENCES)}) OR code = ''")
def licence_filter(spark, sf_dir):
    e = F.col("event_type")
    code = F.when(e == "click", "CC-BY").when(e == "view", "cc0").when(e == "purchase", "").otherwise(e)
    df = table(spark, sf_dir, "events").withColumn("code", code).where(sc.open_licence(F.col("code")) | (F.col("code") == ""))
    return df.select("event_id", F.coalesce(F.nullif("code", F.lit("")), F.lit("all-rights-reserved")).alias("licence"), F.left("props", F.lit(200)).alias("author"))


@query("verdict_cascade", """WITH s AS (SELECT event_id, (event_id * 37 % 101) / 100 AS fish, (event_id * 53 % 97) / 300 AS food, (event_id * 71 % 89) / 250 AS txt FROM events),
v AS (SELECT *, CASE WHEN fish < 0.15 THEN 'suspicious' WHEN txt > 0.20 THEN 'overlay?' WHEN food > 0.15 THEN 'food?' ELSE 'keep' END AS verdict FROM s)
SELECT verdict, count(*) AS n, count(*) FILTER (fish < 0.15) AS low_fish, count(*) FILTER (txt > 0.20) AS overlay, count(*) FILTER (food > 0.15) AS food FROM v GROUP BY verdict""")
def verdict_cascade(spark, sf_dir):
    i = F.col("event_id")
    df = table(spark, sf_dir, "events").select((i * 37 % 101 / 100).alias("fish"), (i * 53 % 97 / 300).alias("foods"), (i * 71 % 89 / 250).alias("txt"))
    df = df.withColumn("verdict", sc.verdict(F.col("fish"), F.col("foods"), F.col("txt")))
    return df.groupBy("verdict").agg(F.count("*").alias("n"), F.count_if(F.col("fish") < 0.15).alias("low_fish"), F.count_if(F.col("txt") > 0.20).alias("overlay"), F.count_if(F.col("foods") > 0.15).alias("food"))


COLOURS = ("red", "green", "part", "blue", "1")


@query("truth_from_name", "WITH c AS (SELECT * FROM (VALUES " + ", ".join(f"({i}, '{c}')" for i, c in enumerate(COLOURS)) + """) v(idx, name))
SELECT p_partkey, p_name, (SELECT arg_min(name, idx) FROM c WHERE contains(lower(p_name), name)) AS truth FROM part""")
def truth_from_name(spark, sf_dir):
    """The first class, in order, that a name contains; the class list is a literal."""
    return table(spark, sf_dir, "part").select("p_partkey", "p_name", cu.first_contained(F.col("p_name"), list(COLOURS)).alias("truth"))


@query("keyword_unique", """SELECT p_partkey, array_to_string(list_filter(list_transform(range(1, len(w) + 1), lambda i: CASE WHEN list_position(w, w[i]) = i THEN w[i] END), lambda x: x IS NOT NULL AND x <> ''), '|') AS words
FROM (SELECT p_partkey, list_concat(string_split(p_name, ' '), string_split(p_type, ' '), string_split(p_name, ' '), [' photo ']) AS w0 FROM part), LATERAL (SELECT list_transform(w0, lambda x: trim(x)) AS w)""")
def keyword_unique(spark, sf_dir):
    name, kind = F.split("p_name", " "), F.split("p_type", " ")
    return table(spark, sf_dir, "part").select("p_partkey", F.array_join(sc.ordered_unique(name, kind, name, F.array(F.lit(" photo "))), "|").alias("words"))


@query("selector_expand", """WITH args AS (SELECT * FROM (VALUES (0, 'ASIA'), (1, 'FRANCE'), (2, 'EUROPE')) v(pos, arg)),
m AS (SELECT pos, n_nationkey, n_name FROM args JOIN region ON r_name = arg JOIN nation ON n_regionkey = r_regionkey UNION ALL SELECT pos, n_nationkey, n_name FROM args JOIN nation ON n_name = arg),
f AS (SELECT n_name, n_nationkey, min(pos) AS pos FROM m GROUP BY ALL) SELECT n_name, row_number() OVER (ORDER BY pos, n_nationkey) AS place FROM f""")
def selector_expand(spark, sf_dir):
    """Names and aliases to members in order of argument; a member stands where it first occurs."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    aliases = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("r_name").alias("alias"), F.col("n_nationkey").alias("idx"))
    classes = nation.select(F.col("n_nationkey").alias("idx"), F.col("n_name").alias("name"))
    return cu.expand_selectors(["ASIA", "FRANCE", "EUROPE"], classes, aliases, strict=False).withColumnRenamed("name", "n_name")


@query("quality_join_default", "SELECT d.doc_id, lang AS class, coalesce(CAST(quality AS DOUBLE), 1.0) AS score FROM documents d LEFT JOIN labels USING (doc_id) WHERE coalesce(CAST(quality AS DOUBLE), 1.0) >= 0.5")
def quality_join_default(spark, sf_dir):
    scores = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("double").alias("score"))
    return cu.with_default(docs(spark, sf_dir).select("doc_id", "class"), scores, ["doc_id"], "score", 1.0).where("score >= 0.5")


@query("rejected_anti", "SELECT lang AS class, count(*) AS n FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND toxic = 1) GROUP BY lang")
def rejected_anti(spark, sf_dir):
    kept = cu.without(docs(spark, sf_dir).select("doc_id", "class"), table(spark, sf_dir, "labels").where("toxic = 1").select("doc_id"), ["doc_id"])
    return kept.groupBy("class").agg(F.count("*").alias("n"))


@query("deleted_diff", "SELECT lang AS class, doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def deleted_diff(spark, sf_dir):
    return cu.without(docs(spark, sf_dir).select("class", "doc_id"), table(spark, sf_dir, "labels").select("doc_id"), ["doc_id"])


@query("label_conflicts", "SELECT md5(text) AS key, array_to_string(list_sort(list(DISTINCT source)), '|') AS labels, count(*) AS n FROM documents GROUP BY 1 HAVING count(DISTINCT source) > 1")
def label_conflicts(spark, sf_dir):
    df = table(spark, sf_dir, "documents").select(F.md5("text").alias("key"), "source")
    return cu.label_conflicts(df, "key", "source").withColumn("labels", F.array_join("labels", "|"))


@query("conflict_removal", "SELECT doc_id FROM documents WHERE md5(text) NOT IN (SELECT md5(text) FROM documents GROUP BY 1 HAVING count(DISTINCT source) > 1)")
def conflict_removal(spark, sf_dir):
    return cu.without_conflicts(table(spark, sf_dir, "documents").select("doc_id", F.md5("text").alias("key"), "source"), "key", "source").select("doc_id")


@query("dedup_exact_first", "SELECT lang AS class, min(doc_id) AS doc_id, md5(text) AS key FROM documents GROUP BY lang, md5(text)")
def dedup_exact_first(spark, sf_dir):
    return cu.first_copies(docs(spark, sf_dir).select("class", "doc_id", F.md5("text").alias("key")), ["class", "key"], ["doc_id"])


@query("dedup_best_rep", """SELECT p_brand, p_partkey, name FROM (SELECT *, row_number() OVER (PARTITION BY p_brand ORDER BY CASE WHEN starts_with(name, 'inat_') THEN 0 ELSE 1 END, p_retailprice DESC, name) AS nth
  FROM (SELECT *, CASE WHEN p_partkey % 7 = 0 THEN 'inat_' ELSE 'web_' END || p_partkey AS name FROM part)) WHERE nth = 1""")
def dedup_best_rep(spark, sf_dir):
    name = F.concat(F.when(F.col("p_partkey") % 7 == 0, "inat_").otherwise("web_"), F.col("p_partkey").cast("string"))
    return cu.best_copies(table(spark, sf_dir, "part").withColumn("name", name), ["p_brand"], F.col("p_retailprice"), "name").select("p_brand", "p_partkey", "name")


@query("dedup_funnel", """WITH s AS (SELECT lang AS class, doc_id, CASE WHEN toxic = 1 THEN 'rejected' WHEN n_chars < 50 THEN 'broken' END AS stage, md5(text) AS key FROM documents LEFT JOIN labels USING (doc_id)),
k AS (SELECT class, coalesce(stage, CASE WHEN row_number() OVER (PARTITION BY class, key, stage IS NULL ORDER BY doc_id) = 1 THEN 'kept' ELSE 'exact' END) AS stage FROM s)
SELECT class, count(*) AS raw, count(*) FILTER (stage = 'rejected') AS rejected, count(*) FILTER (stage = 'broken') AS broken, count(*) FILTER (stage = 'exact') AS exact, count(*) FILTER (stage = 'kept') AS kept FROM k GROUP BY ROLLUP(class)""")
def dedup_funnel(spark, sf_dir):
    """Rejected before broken before exact copies, so a copy of a dropped row may stay."""
    df = docs(spark, sf_dir).join(table(spark, sf_dir, "labels").select("doc_id", "toxic"), "doc_id", "left")
    early = F.when(F.col("toxic") == 1, "rejected").when(F.col("n_chars") < 50, "broken")
    df = df.select("class", "doc_id", early.alias("early"), F.md5("text").alias("key"))
    nth = F.row_number().over(Window.partitionBy("class", "key", F.col("early").isNull()).orderBy("doc_id"))
    return cu.funnel(df.withColumn("stage", F.coalesce("early", F.when(nth == 1, "kept").otherwise("exact"))), "stage")


def fingerprints(spark, sf_dir):
    """(id, class, h): bit i is set where dimension i exceeds the row's median."""
    v = F.transform("embedding", lambda x: x.cast("double"))
    ranked = F.array_sort(v)
    middle = (F.element_at(ranked, 32) + F.element_at(ranked, 33)) / 2
    bit = lambda m: lambda x, i: F.when(x > m, F.call_function("shiftleft", F.lit(1).cast("long"), i)).otherwise(F.lit(0).cast("long"))
    # The median is bound by a lambda of its own, so that it is found once a row and not for each dimension.
    bits = F.element_at(F.transform(F.array(middle), lambda m: F.aggregate(F.transform(v, bit(m)), F.lit(0).cast("long"), lambda a, b: a.bitwiseOR(b))), 1)
    return table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("id"), F.col("label").alias("class"), bits.alias("h"))


_PRINTS = """WITH RECURSIVE m AS (SELECT vec_id, label, embedding, list_aggregate(list_transform(embedding, lambda x: CAST(x AS DOUBLE)), 'median') AS mid FROM embeddings),
f AS (SELECT vec_id AS id, label AS class, list_transform(embedding, lambda x: CASE WHEN CAST(x AS DOUBLE) > mid THEN '1' ELSE '0' END) AS bits FROM m),
h AS (SELECT id, class, CAST(array_to_string(bits, '') AS BIT) AS h FROM f)
"""


@query("hamming_cross_class", _PRINTS + "SELECT a.id AS a, b.id AS b, CAST(bit_count(xor(a.h, b.h)) AS INT) AS distance FROM h a JOIN h b ON a.id < b.id AND a.class <> b.class WHERE bit_count(xor(a.h, b.h)) <= 20")
def hamming_cross_class(spark, sf_dir):
    return cu.hamming_pairs(fingerprints(spark, sf_dir), 20)


#: Each class in order of id, a row a step: the list of leaders so far, and the first of them that is near.
LEADERS = _PRINTS + """, o AS (SELECT *, row_number() OVER (PARTITION BY class ORDER BY id) AS k FROM h),
w AS (SELECT class, k, id, id AS leader, [{'id': id, 'h': h}] AS heads FROM o WHERE k = 1
  UNION ALL SELECT class, k, id, coalesce(near, id), CASE WHEN near IS NULL THEN list_append(heads, {'id': id, 'h': h}) ELSE heads END
  FROM (SELECT o.*, w.heads, list_filter(w.heads, lambda x: bit_count(xor(x.h, o.h)) <= 20)[1].id AS near FROM w JOIN o ON o.class = w.class AND o.k = w.k + 1))
"""


@query("greedy_leader_clusters", LEADERS + "SELECT class, id, leader FROM w")
def greedy_leader_clusters(spark, sf_dir):
    return cu.leader_clusters(fingerprints(spark, sf_dir), 20)


@query("class_weights", f"""WITH c AS (SELECT class, count(doc_id) AS n FROM {_LANGS} LEFT JOIN documents ON lang = class GROUP BY class)
SELECT class, n, coalesce(CAST(sum(n) OVER () AS DOUBLE) / nullif(count(nullif(n, 0)) OVER () * n, 0), 0.0) AS weight, coalesce(1.0 / nullif(n, 0), 0.0) AS sampler FROM c""")
def class_weights(spark, sf_dir):
    return cu.class_weights(docs(spark, sf_dir), langs(spark))


@query("round_robin", "SELECT p_brand, p_partkey, row_number() OVER (ORDER BY nth, p_brand) AS turn FROM (SELECT p_brand, p_partkey, row_number() OVER (PARTITION BY p_brand ORDER BY p_partkey) AS nth FROM part)")
def round_robin(spark, sf_dir):
    return cu.round_robin(table(spark, sf_dir, "part"), "p_brand", ["p_partkey"]).select("p_brand", "p_partkey", "turn")


@query("append_first_wins", "SELECT user_id, event_type, min(event_id) AS event_id FROM events GROUP BY 1, 2 HAVING min(event_id) FILTER (event_id < 100) IS NULL")
def append_first_wins(spark, sf_dir):
    """Events from 100 on appended to a log of the ones before: the first of each key that is new."""
    events, keys = table(spark, sf_dir, "events"), ["user_id", "event_type"]
    return cu.append_first(events.where("event_id < 100"), events.where("event_id >= 100"), keys, ["event_id"]).select(*keys, "event_id")


@query("quota_plan", """WITH h AS (SELECT c_mktsegment AS segment, count(*) AS have, count(*) FILTER (c_acctbal > 0) AS web FROM customer GROUP BY 1)
SELECT segment, have, web, CAST(greatest(350 - have, 250 - web, 0) AS BIGINT) AS need, CAST(greatest(10, ceil(greatest(350 - have, 250 - web, 0) / 7)) AS INT) AS per_keyword, CAST(floor(greatest(350 - have, 250 - web, 0) * 1.6) + 10 AS INT) AS fetch FROM h""")
def quota_plan(spark, sf_dir):
    df = table(spark, sf_dir, "customer").groupBy(F.col("c_mktsegment").alias("segment")).agg(F.count("*").alias("have"), F.count_if(F.col("c_acctbal") > 0).alias("web"))
    df = df.withColumn("need", sc.need(350, F.col("have"), 250, F.col("web")))
    return df.withColumn("per_keyword", sc.per_keyword(F.col("need"), F.lit(7))).withColumn("fetch", sc.over_fetch(F.col("need")))


@query("integrity_violations", """SELECT 'nation_region' AS rule, n_name AS who FROM nation WHERE n_regionkey NOT IN (SELECT r_regionkey FROM region) OR n_nationkey % 10 = 3
UNION ALL SELECT 'unique_name', n_name FROM nation GROUP BY n_name HAVING count(*) > 1 UNION ALL SELECT 'empty_name', r_name FROM region WHERE trim(r_name) = ''""")
def integrity_violations(spark, sf_dir):
    """Rows that break a rule; the first rule takes some rows' key as broken, so that there are any."""
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    key = F.when(F.col("n_nationkey") % 10 == 3, F.lit(-1)).otherwise(F.col("n_regionkey"))
    broken = cu.orphans(nation.withColumn("key", key), "key", region, "r_regionkey", "nation_region", "n_name")
    return broken.unionByName(cu.repeated(nation, "n_name", "unique_name")).unionByName(cu.blank(region, "r_name", "empty_name"))


@query("resize_geometry", """WITH s AS (SELECT doc_id, n_chars AS h, greatest(1, doc_id % 900) AS w FROM documents),
r AS (SELECT doc_id, CAST(greatest(1, round_even(h * (437.0::DOUBLE / least(h, w)), 0)) AS INT) AS h2, CAST(greatest(1, round_even(w * (437.0::DOUBLE / least(h, w)), 0)) AS INT) AS w2 FROM s)
SELECT doc_id, h2, w2, CAST(floor((h2 - 384) / 2) AS INT) AS top, CAST(floor((w2 - 384) / 2) AS INT) AS lft FROM r""")
def resize_geometry(spark, sf_dir):
    df = table(spark, sf_dir, "documents").select("doc_id", F.col("n_chars").alias("h"), F.greatest(F.lit(1), F.col("doc_id") % 900).alias("w"))
    h2, w2 = sc.resized_shape(F.col("h"), F.col("w"), 437)
    df = df.select("doc_id", h2.alias("h2"), w2.alias("w2"))
    return df.withColumn("top", sc.crop_offset(F.col("h2"), 384)).withColumn("lft", sc.crop_offset(F.col("w2"), 384))


def order_lines(spark, sf_dir):
    lines = line_files(spark, sf_dir).join(table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    return lines.select(F.col("o_orderpriority").alias("class"), "name", F.col("l_orderkey").cast("string").alias("grp"))


@query("group_split_exact")
def group_split_exact(spark, sf_dir):
    return cu.group_split(order_lines(spark, sf_dir))


@query("group_split_hash", f"SELECT o_orderpriority AS class, l_orderkey AS grp, {_SPLIT} AS split, count(*) AS n FROM (SELECT *, {_BUCKET.format('o_orderpriority', 'l_orderkey')} AS b FROM lineitem JOIN orders ON l_orderkey = o_orderkey) GROUP BY 1, 2, 3")
def group_split_hash(spark, sf_dir):
    df = order_lines(spark, sf_dir).groupBy("class", F.col("grp").cast("long").alias("grp")).agg(F.count("*").alias("n"))
    return df.withColumn("split", cu.hashed_split(F.col("grp"), F.col("class")))
