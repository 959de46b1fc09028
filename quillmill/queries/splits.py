"""Projections, filters, splits, samples and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from quillmill.functions import columns as c
from quillmill.operators import columns as cols
from quillmill.operators import combine, splits, stats
from quillmill.plans.corpus import split_manifests
from quillmill.queries.base import DOCS, SPLIT, documents, query, split_documents, table


@query(
    "path_reroot",
    r"""SELECT page_id, '/data/corpus/' || array_to_string(string_split(url, '/')[4:], '/') AS path
        FROM pages""",
)
def path_reroot(spark, sf):
    pages = table(spark, sf, "pages")
    return pages.select("page_id", c.reroot_path(F.col("url"), "/data/corpus", drop=3).alias("path"))


@query(
    "shard_keys",
    f"""WITH {DOCS} SELECT doc_id, year * 100 + month AS yymm,
        lpad((year * 100 + month)::VARCHAR, 4, '0') AS label FROM docs""",
)
def shard_keys(spark, sf):
    docs = documents(spark, sf)
    y, m = F.col("year"), F.col("month")
    return docs.select("doc_id", c.shard_key(y, m).alias("yymm"), c.shard_label(y, m).alias("label"))


@query("shard_filter", f"WITH {DOCS} SELECT doc_id, source FROM docs WHERE year = 2 AND month = 11")
def shard_filter(spark, sf):
    y, m = F.col("year"), F.col("month")
    manifest = documents(spark, sf).withColumn("month", c.shard_key(y, m))
    return cols.shard_filter(manifest, 2, 11).select("doc_id", "source")


@query(
    "rows_without_nulls",
    """SELECT doc_id, lang, quality, toxic FROM documents LEFT JOIN labels USING (doc_id)
       WHERE quality IS NOT NULL AND toxic IS NOT NULL AND lang IS NOT NULL""",
)
def rows_without_nulls(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "lang")
    return cols.drop_null_rows(docs.join(table(spark, sf, "labels"), "doc_id", "left"))


@query("columns_dropped", "SELECT doc_id, lang, n_chars FROM documents")
def columns_dropped(spark, sf):
    return cols.drop_columns(table(spark, sf, "documents"), ["text", "source"])


@query("signature_columns", "SELECT label, vec_id FROM embeddings")
def signature_columns(spark, sf):
    kept, _ = cols.select_signature(table(spark, sf, "embeddings"), ["label", "input_ids", "vec_id"])
    return kept


@query("text_column_choice", "SELECT html AS text, page_id FROM pages")
def text_column_choice(spark, sf):
    return cols.text_column(table(spark, sf, "pages").select("html", "page_id"))


@query(
    "nonfinite_values",
    """WITH e AS (SELECT CASE WHEN vec_id % 89 = 0 THEN list_transform(embedding, lambda x: 'nan'::FLOAT)
                         WHEN vec_id % 97 = 0 THEN list_transform(embedding, lambda x: 'inf'::FLOAT)
                         ELSE embedding END AS embedding, ln(label::DOUBLE + 1) AS scalar FROM embeddings),
       f AS (SELECT len(embedding) AS n, len(list_filter(embedding, lambda x: isnan(x))) AS nan,
                    len(list_filter(embedding, lambda x: isinf(x))) AS inf,
                    isnan(scalar)::INT AS snan, isinf(scalar)::INT AS sinf FROM e)
       SELECT 'embedding' AS column_name, sum(n)::BIGINT AS n_values, sum(nan)::BIGINT AS n_nan,
              sum(inf)::BIGINT AS n_inf, count_if(nan > 0 OR inf > 0)::BIGINT AS n_bad_rows FROM f
       UNION ALL SELECT 'scalar', count(*), sum(snan)::BIGINT, sum(sinf)::BIGINT,
              count_if(snan > 0 OR sinf > 0)::BIGINT FROM f""",
)
def nonfinite_values(spark, sf):
    filled = {97: float("inf"), 89: float("nan")}
    broken = F.col("embedding")
    for every, value in filled.items():
        spoiled = F.transform("embedding", lambda x: F.when(x.isNotNull(), F.lit(value).cast("float")))
        broken = F.when(F.col("vec_id") % every == 0, spoiled).otherwise(broken)
    rows = table(spark, sf, "embeddings").select(
        broken.alias("embedding"), F.log(F.col("label").cast("double") + 1).alias("scalar")
    )
    return cols.nonfinite_report(rows, ["embedding", "scalar"])


@query("head_fraction_split", f"WITH {SPLIT} SELECT doc_id, year, month, split FROM tagged")
def head_fraction_split(spark, sf):
    return split_documents(spark, sf).select("doc_id", "year", "month", "split")


@query(
    "manifest_splits",
    f"""WITH {DOCS}, r AS (SELECT *, row_number() OVER (PARTITION BY lang = 'en', year, month ORDER BY doc_id) - 1 AS pos,
              count(*) OVER (PARTITION BY lang = 'en', year, month) AS n FROM docs),
        s AS (SELECT doc_id, year, month, CASE
              WHEN lang = 'en' THEN CASE WHEN pos < floor(n * 0.29::DOUBLE) THEN 'train' END
              WHEN pos < floor(n * 0.5::DOUBLE) THEN 'val'
              WHEN pos < floor(n * 0.5::DOUBLE) + floor(n * 0.25::DOUBLE) THEN 'test' END AS split FROM r)
        SELECT * FROM s WHERE split IS NOT NULL""",
)
def manifest_splits(spark, sf):
    docs = documents(spark, sf).select("doc_id", "lang", "year", "month")
    english = F.col("lang") == "en"
    out = split_manifests(docs.where(english), docs.where(~english), 0.29, 0.5, 0.25, ["doc_id"])
    return out.drop("lang")


@query(
    "percent_split",
    """SELECT conv_id, turn, CASE WHEN row_number() OVER (ORDER BY conv_id, turn)
              <= round_even(count(*) OVER () * 5.0::DOUBLE / 100, 0) THEN 'validation' ELSE 'train' END AS split
       FROM conversations""",
)
def percent_split(spark, sf):
    rows = table(spark, sf, "conversations").select("conv_id", "turn")
    return splits.percent_split(rows, 5, ["conv_id", "turn"])


@query(
    "percent_slice",
    """SELECT * EXCLUDE (r, n) FROM (SELECT doc_id, lang, row_number() OVER (ORDER BY doc_id) - 1 AS r,
                                            count(*) OVER () AS n FROM documents)
       WHERE r >= round_even(n * 12.5::DOUBLE / 100, 0) AND r < round_even(n * 37.5::DOUBLE / 100, 0)""",
)
def percent_slice(spark, sf):
    rows = table(spark, sf, "documents").select("doc_id", "lang")
    return splits.percent_slice(rows, 12.5, 37.5, ["doc_id"])


@query(
    "random_holdout",
    """SELECT doc_id, CASE WHEN row_number() OVER (ORDER BY md5(doc_id || ':42'), doc_id)
              <= round_even(count(*) OVER () * 0.1::DOUBLE, 0) THEN 'eval' ELSE 'train' END AS split
       FROM documents""",
)
def random_holdout(spark, sf):
    return splits.random_holdout(table(spark, sf, "documents").select("doc_id"), 0.1, 42, "doc_id")


@query(
    "holdout_remainder",
    """WITH r AS (SELECT doc_id, lang, row_number() OVER (ORDER BY md5(doc_id || ':42'), doc_id) AS r,
                         count(*) OVER () AS n FROM documents)
       SELECT lang, count(*) AS n_train FROM r WHERE r > round_even(n * 0.25::DOUBLE, 0) GROUP BY lang""",
)
def holdout_remainder(spark, sf):
    rows = table(spark, sf, "documents").select("doc_id", "lang")
    train = splits.random_holdout(rows, 0.25, 42, "doc_id").where(F.col("split") == "train")
    return train.groupBy("lang").agg(F.count(F.lit(1)).alias("n_train"))


@query("first_rows", "SELECT doc_id, source, n_chars FROM documents ORDER BY doc_id LIMIT 64")
def first_rows(spark, sf):
    rows = table(spark, sf, "documents").select("doc_id", "source", "n_chars")
    return splits.take_first(rows, 64, ["doc_id"])


@query("clamped_rows", "SELECT vec_id, label FROM embeddings ORDER BY vec_id LIMIT 1000000")
def clamped_rows(spark, sf):
    return splits.take_clamped(table(spark, sf, "embeddings").select("vec_id", "label"), 1_000_000, ["vec_id"])


@query("random_peek", "SELECT doc_id, lang FROM documents ORDER BY md5(doc_id || ':7'), doc_id LIMIT 3")
def random_peek(spark, sf):
    return splits.peek_random(table(spark, sf, "documents").select("doc_id", "lang"), 3, 7, "doc_id")


@query(
    "union_sources",
    """SELECT kind, count(*) AS n_rows, sum(length(text))::BIGINT AS n_chars FROM
       (SELECT 'tex' AS kind, text FROM documents UNION ALL SELECT 'bbl', text FROM benchmark) GROUP BY kind""",
)
def union_sources(spark, sf):
    tex = table(spark, sf, "documents").select(F.lit("tex").alias("kind"), "text")
    bbl = table(spark, sf, "benchmark").select(F.lit("bbl").alias("kind"), "text")
    rows = combine.union_sources(tex, bbl)
    return rows.groupBy("kind").agg(F.count(F.lit(1)).alias("n_rows"), F.sum(F.length("text")).alias("n_chars"))


@query(
    "manifest_missing_files",
    "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)",
)
def manifest_missing_files(spark, sf):
    manifest = table(spark, sf, "documents").select("doc_id")
    return combine.missing_files(manifest, table(spark, sf, "labels"), "doc_id")


@query(
    "manifest_join",
    """SELECT doc_id, lang, quality FROM documents JOIN labels USING (doc_id)""",
)
def manifest_join(spark, sf):
    manifest = table(spark, sf, "documents").select("doc_id", "lang")
    return combine.join_manifest(manifest, table(spark, sf, "labels").select("doc_id", "quality"), "doc_id")


GRID = "grid AS (SELECT (i // 12)::INT AS year, (1 + i % 12)::INT AS month FROM range(288) t(i))"


@query(
    "shard_grid_counts",
    f"""WITH {SPLIT}, {GRID}, e AS (SELECT * FROM grid, (VALUES ('train'), ('val'), ('test')) s(split))
        SELECT e.split, e.year, e.month, count(t.doc_id) AS n_rows, count(t.doc_id) = 0 AS is_empty
        FROM e LEFT JOIN tagged t ON t.split = e.split AND t.year = e.year AND t.month = e.month
        GROUP BY ALL""",
)
def shard_grid_counts(spark, sf):
    rows = split_documents(spark, sf).select("split", "year", "month")
    return stats.split_counts(rows, combine.shard_grid(spark), ["train", "val", "test"])


@query(
    "split_rollup",
    f"WITH {SPLIT} SELECT split, year, month, count(*) AS n_rows FROM tagged GROUP BY ROLLUP (split, year, month)",
)
def split_rollup(spark, sf):
    return stats.split_rollup(split_documents(spark, sf).select("split", "year", "month"))


@query(
    "missing_shards",
    f"""WITH {SPLIT}, {GRID}, p AS (SELECT year, month, bool_or(split = 'train') AS t, bool_or(split = 'val') AS v
              FROM tagged GROUP BY year, month)
        SELECT year, month, NOT coalesce(t, false) AS no_train, NOT coalesce(v, false) AS no_val
        FROM grid LEFT JOIN p USING (year, month) WHERE NOT coalesce(t, false) OR NOT coalesce(v, false)""",
)
def missing_shards(spark, sf):
    present = split_documents(spark, sf).select("split", "year", "month").distinct()
    return combine.missing_shards(combine.shard_grid(spark), present)


@query(
    "combined_splits",
    """SELECT split, count(*) AS n_rows, count(DISTINCT lang) AS n_langs FROM
       (SELECT 'train' AS split, lang FROM documents WHERE lang = 'en'
        UNION ALL SELECT 'validation', lang FROM documents WHERE lang <> 'en') GROUP BY split""",
)
def combined_splits(spark, sf):
    docs = table(spark, sf, "documents").select("lang")
    english = F.col("lang") == "en"
    both = combine.combine_splits({"train": docs.where(english), "validation": docs.where(~english)})
    return both.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("lang").alias("n_langs"))


@query(
    "split_leaks",
    f"""WITH {SPLIT} SELECT md5(text) AS text_md5, string_agg(DISTINCT split, ',' ORDER BY split) AS splits,
        count(*) AS n_rows FROM tagged GROUP BY md5(text) HAVING count(DISTINCT split) > 1""",
)
def split_leaks(spark, sf):
    overlap = combine.split_overlap(split_documents(spark, sf))
    return overlap.withColumn("splits", F.array_join("splits", ","))
