"""The registered queries of this folder: each applies its operator to a whole table and derives the digest columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontam, fim, licenses, linededup, neardup, packing, periods, pii, quality, repeats, secrets, toxicity, urls

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents"))
    name = lambda c: F.concat_ws(":", c["kind"], c["start"].cast("string"), c["end"].cast("string"))
    joined = lambda c: F.array_join(F.transform(c, name), ",")
    counts = [F.size(F.expr(f"filter(base, c -> c.kind = '{k}')")).cast("long").alias(f"n_{k}") for k in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(joined(F.col("base")), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = linededup.dedup(table(spark, sf_dir, "documents"), counts=True)
    return cleaned.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    net = toxicity.train(docs, labels.where(~held_out).select("doc_id", "toxic"))
    scored = toxicity.score(docs, net)
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = neardup.classes(table(spark, sf_dir, "documents"), params=neardup.Params(shingle_words=3, percent=85))
    return found.select("doc_id", "n_shingles", "component_id", (F.col("doc_id") == F.col("component_id")).alias("kept"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(table(spark, sf_dir, "documents"))
    base = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", base.alias("base_failed"), (~base & F.col("kept")).alias("kept"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.dedup(table(spark, sf_dir, "documents"), with_bytes=False).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), with_ids=False)
    return pieces.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan(table(spark, sf_dir, "documents"))
    base = F.col("base")
    base_labels = F.array_distinct(F.transform(base, lambda x: x["label"]))
    labels = F.array_union(base_labels, F.transform("matches", lambda x: x["label"]))
    word = F.transform(base, lambda x: x["word"])
    return found.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(word).alias("first_word"),
        F.array_max(word).alias("last_word"),
        F.array_join(F.array_sort(base_labels), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(labels)), ",").alias("labels"),
        "score",
        F.array_join(F.transform("matches", lambda x: F.concat_ws(":", x["label"], x["first_word"].cast("string"), x["end_word"].cast("string"), x["edits"].cast("string"))), ",").alias("matches"),
    )


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page's label is that of the document whose number its path carries: bad where the document's quality is 0."""
    pages = table(spark, sf_dir, "pages")
    number = F.expr("try_cast(regexp_extract(url, '://[^/?#]*/[^?#]*?([0-9]+)[^0-9?#]*([?#]|$)', 1) AS BIGINT)")
    bad = table(spark, sf_dir, "labels").select("doc_id", (1 - F.col("quality")).alias("bad"))
    labels = pages.select("page_id", number.alias("doc_id")).join(bad, "doc_id").select("page_id", "bad")
    return urls.judge(pages, labels).select("page_id", "host", "path", "rule", "verdict", "template", "purity")


def op11_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The span of an assignment is its whole match, name and value."""
    found = secrets.scan(table(spark, sf_dir, "documents"))
    name = lambda c: F.concat_ws(":", c["kind"], c["start"].cast("string"), c["end"].cast("string"))
    joined = lambda c: F.array_join(F.transform(c, name), ",")
    counts = [F.size(F.expr(f"filter(spans, s -> s.kind = '{k}')")).cast("long").alias(f"n_{k}") for k in secrets.BASE]
    base = F.filter("spans", lambda s: s["kind"].isin(*secrets.BASE))
    formats = F.array_join(F.filter(F.transform("spans", lambda s: s["format"]), lambda f: f != ""), ",").alias("formats")
    return found.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"), formats)


def planted(text: Column, key: Column) -> Column:
    """The text, in one of ten documents with its words from a place on replaced by repeats of the first of them; place and period follow from the key's
    checksum. Without a key the text stays."""
    h = F.crc32(key.cast("string").cast("binary"))
    g = F.floor(h / 10)

    def periodic(w: Column) -> Column:
        n = F.size(w)
        a = (g % F.greatest(n, F.lit(1))).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        times = F.ceil((n - a) / p).cast("int")
        tail = F.slice(F.flatten(F.array_repeat(F.slice(w, a + 1, p), times)), 1, n - a)
        return F.when(n > 0, F.array_join(F.concat(F.slice(w, 1, a), tail), " ")).otherwise(text)

    words = F.regexp_extract_all(text, F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    return F.when(h % 10 == 0, F.get(F.transform(F.array(words), periodic), F.lit(0))).otherwise(text)  # the lambda binds the words once


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = periods.find(docs.select("doc_id", planted(F.col("text"), F.col("doc_id")).alias("text")))
    best = F.col("strongest")
    line = lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n"))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        best["start"].alias("start"),
        best["length"].alias("length"),
        best["period"].alias("period"),
        F.expr("1000 * strongest.length div strongest.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = fim.transform(table(spark, sf_dir, "documents"))
    rebuilt = F.sha2(fim.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256")
    return cut.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), rebuilt)


def queries() -> dict[str, Query]:
    return {
        "op1_pii": op1_pii,
        "op2_line_dedup": op2_line_dedup,
        "op3_toxicity": op3_toxicity,
        "op4_minhash": op4_minhash,
        "op5_quality_rules": op5_quality_rules,
        "op6_suffix_dedup": op6_suffix_dedup,
        "op7_packing": op7_packing,
        "op8_license_scan": op8_license_scan,
        "op9_decontamination": op9_decontamination,
        "op10_url_filter": op10_url_filter,
        "op11_secret_scan": op11_secret_scan,
        "op12_periodic_runs": op12_periodic_runs,
        "op13_fill_in_middle": op13_fill_in_middle,
    }


_QUALITY_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
r AS (SELECT doc_id, count(DISTINCT pos) AS n_repeat_words FROM (
    SELECT doc_id, unnest([i, i + 1, i + 2, i + 3, i + 4]) AS pos FROM (
        SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, key) AS times FROM (
            SELECT doc_id, i, array_to_string(w[i : i + 4], ' ') AS key FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5))) WHERE times > 1) GROUP BY 1),
l AS (SELECT doc_id, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
m AS (SELECT d.doc_id, len(w) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars, length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, len(lines) AS n_lines, length(regexp_replace(t, '[^!?]', '', 'g')) AS n_exclaims,
    len(list_filter(w, lambda x: regexp_matches(x, '[A-Za-z\x{80}-\x{10FFFF}]'))) AS n_letters FROM d JOIN l USING (doc_id) LEFT JOIN r USING (doc_id)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT (base_failed OR 10 * n_symbols > n_words OR 10 * n_exclaims > 4 * n_words OR word_chars < 2 * n_words OR word_chars > 15 * n_words
    OR 10 * n_letters < 7 * n_words OR 2 * n_dup_lines > n_lines) AS kept FROM b
"""

_LEAKS_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
k AS (SELECT item, w, least(10, len(w)) AS n FROM b WHERE len(w) > 0),
windows AS (SELECT DISTINCT item, n, array_to_string(w[i : i + n - 1], ' ') AS key FROM (SELECT item, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM k)),
places AS (SELECT doc_id, i, n, array_to_string(w[i : i + n - 1], ' ') AS key FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d CROSS JOIN (SELECT DISTINCT n FROM k) WHERE len(w) >= n)),
found AS (SELECT doc_id, item, i, n FROM places JOIN windows USING (n, key)),
hits AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS pos FROM found) GROUP BY 1),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY 1)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
"""


_MIDDLE_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS w, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS x FROM documents),
h AS (SELECT doc_id, t, w, len(w) AS n, CAST('0x' || x[1:8] AS BIGINT) % (len(w) + 1) AS a, CAST('0x' || x[9:16] AS BIGINT) % (len(w) + 1) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR CAST('0x' || x[17:24] AS BIGINT) % 100 >= 50 THEN 'plain' WHEN CAST('0x' || x[25:32] AS BIGINT) % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM d),
p AS (SELECT doc_id, t, n, form, array_to_string(w[1 : least(a, b)], '') AS prefix, array_to_string(w[least(a, b) + 1 : greatest(a, b)], '') AS middle, array_to_string(w[greatest(a, b) + 1 : n], '') AS suffix FROM h)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(prefix) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(middle) END AS middle_chars,
    sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
    sha256(CASE form WHEN 'plain' THEN t ELSE prefix || middle || suffix END) AS restored_sha256 FROM p
"""


def oracle_sql() -> dict[str, str]:
    """The other queries rest on a trained model, a tokenizer, fuzzy matching or components; tests compare them with plain-Python versions."""
    return {"op5_quality_rules": _QUALITY_SQL, "op9_decontamination": _LEAKS_SQL, "op13_fill_in_middle": _MIDDLE_SQL}
