"""A content-addressed Merkle manifest: a proof for every record of a dataset, checked against one root.

Records are leaves of one tree per group (source), the trees' roots are leaves of a tree of their own.
Three neighbours become one node. Each step of building turns ``SPAN`` neighbouring nodes, at most
``DEPTH`` levels, into one record of a table keyed by digest: digest -> its children, level by level.
Proofs are read by descending from the root: a request looks its digest up, follows the base-3 digits
of its rank, collects the children it doesn't select and goes on with the one it does. Requests with
the same leading digits travel as one until they reach the leaves, so only their last step is as long
as the dataset. Path segments come root first and are reversed at the end.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quillmill.llm.common import materialize, read
from quillmill.llm.registry import query
from quillmill.operators.ordering import range_bucket, row_index, running

#: Children of a node; levels in one record of the table, and leaves below it.
WIDTH, DEPTH = 3, 6
SPAN = WIDTH**DEPTH

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def _packed(value: Column) -> Column:
    """UTF-8 byte count, colon, value; ``-`` for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def record_digest(*values: Column) -> Column:
    return F.sha2(F.concat(*[_packed(v) for v in values]), 256)


def _power(k: Column) -> Column:
    return F.get(F.array(*[F.lit(WIDTH**i) for i in range(DEPTH + 1)]), k)


def _levels(base: Column, n: Column) -> Column:
    """Nodes of all levels below and with the record's own node; ``n`` nodes of the tree are at the lowest one."""

    def up(levels: Column, width: Column) -> Column:
        below = F.element_at(levels, -1)
        runs = F.sequence(F.lit(0), F.floor((F.size(below) - 1) / WIDTH).cast("int"))
        nodes = F.transform(runs, lambda i: F.sha2(F.array_join(F.slice(below, i * WIDTH + 1, WIDTH), ""), 256))
        return F.when(n > width, F.concat(levels, F.array(nodes))).otherwise(levels)

    return F.aggregate(F.array(*[F.lit(WIDTH**i) for i in range(DEPTH)]), F.array(base), up)


def _segment(levels: Column, local: Column) -> Column:
    """What the descent to node ``local`` of the lowest level passes by, root first: digests before and after."""
    steps = F.filter(F.array(*[F.lit(k) for k in reversed(range(DEPTH))]), lambda k: k < F.size(levels) - 1)

    def passed(k: Column) -> Column:
        nodes = F.element_at(levels, k + 1)
        at = F.floor(local / _power(k)).cast("int")
        digit = at % WIDTH
        return F.struct(
            F.array_join(F.slice(nodes, at - digit + 1, digit), "").alias("before"),
            F.array_join(F.slice(nodes, at + 2, F.lit(WIDTH - 1) - digit), "").alias("after"),
        )

    return F.transform(steps, passed)


def _stored(segments: DataFrame, name: str) -> DataFrame:
    """Adds levels and digest to (tree, seg, n, base, ...) and writes the table."""
    kept = [c for c in segments.columns if c != "base"]
    with_levels = segments.select(*kept, _levels(F.col("base"), F.col("n")).alias("levels"))
    return materialize(with_levels.withColumn("digest", F.element_at(F.element_at("levels", -1), 1)), name)


def _upper(lowest: DataFrame, name: str) -> list[DataFrame]:
    """``lowest`` and the tables above it, until every tree has one record."""
    tables = [lowest]
    most = lowest.agg(F.max("n")).first()[0] or 0
    while most > SPAN:
        most = -(-most // SPAN)
        nodes = tables[-1].where(F.col("n") > SPAN)
        up = nodes.groupBy("tree", F.floor(F.col("seg") / SPAN).alias("up"), F.ceil(F.col("n") / SPAN).alias("n")).agg(
            F.array_sort(F.collect_list(F.struct("seg", "digest"))).alias("nodes")  # at most SPAN
        )
        base = up.select("tree", F.col("up").alias("seg"), "n", F.col("nodes.digest").alias("base"))
        tables.append(_stored(base, f"{name}-{len(tables)}"))
    return tables


def _roots(tables: Sequence[DataFrame]) -> DataFrame:
    out = None
    for table in tables:
        done = table.where(F.col("n") <= SPAN).select("tree", "digest")
        out = done if out is None else out.unionByName(done)
    return out


def descend(requests: DataFrame, tables: Sequence[DataFrame], lowest: int = 0) -> DataFrame:
    """``requests`` (digest, path, pos, n, ...) led down to table ``lowest``: the digest there, and the longer path.

    ``digest`` is the root to start from, ``pos`` the rank among the ``n`` leaves of its tree.
    """
    for j in reversed(range(lowest, len(tables))):
        table = tables[j].select(F.col("digest").alias("node"), "levels").dropDuplicates(["node"])
        here = F.col("digest") == F.col("node")
        if j:  # smaller trees begin further down
            here = here & (F.col("n") > SPAN**j)
        local = (F.floor(F.col("pos") / SPAN**j) % SPAN).cast("int")
        found = F.col("levels").isNotNull()
        kept = [c for c in requests.columns if c not in ("digest", "path")]
        requests = requests.join(table, here, "left").select(
            *kept,
            F.when(found, F.concat("path", _segment(F.col("levels"), local))).otherwise(F.col("path")).alias("path"),
            F.when(found, F.get(F.element_at("levels", 1), local)).otherwise(F.col("digest")).alias("digest"),
        )
    return requests


def prove(leaves: DataFrame) -> DataFrame:
    """(id, leaf, changed, subroot, root, proof) of every row of (tree string, id, leaf, changed).

    ``tree`` names the group and orders the groups (bytewise); leaves of a tree ascend by id, null ids
    first, rows of one id by leaf. Repeated rows are leaves of their own. ``proof`` is an array of
    structs (before, after), leaf first: the digests left and right of the path, joined, at each level
    up to the root. No rows give no rows.
    """
    kind = leaves.schema["id"].dataType.simpleString()
    alike = leaves.groupBy("tree", "id", "leaf", "changed").agg(F.count("*").alias("m"))
    order = ["known", "key", "leaf", "changed"]
    alike = alike.withColumn("known", F.col("id").isNotNull()).withColumn("key", F.coalesce("id", F.lit(0).cast(kind)))
    alike = materialize(alike, "leaves")
    # enough ranges that a tree with a third of all leaves is many small tasks
    ranges = range_bucket(alike, ["known", "key"], least=2 * int(leaves.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    ranked = running(alike, order, {"upto": ("sum", F.col("m"))}, ["tree"], ranges, totals=True)
    start = F.col("upto") - F.col("m")
    segments = F.sequence(F.floor(start / SPAN), F.floor((F.col("upto") - 1) / SPAN))
    spread = ranked.select("tree", "id", "leaf", "changed", F.col("upto_total").alias("n"), start.alias("start"), "upto", F.explode(segments).alias("seg"))
    first = F.greatest(F.col("start"), F.col("seg") * SPAN)
    times = (F.least(F.col("upto"), (F.col("seg") + 1) * SPAN) - first).cast("int")
    entries = spread.withColumn("first", first).withColumn("times", times).groupBy("tree", "seg", "n").agg(
        F.array_sort(F.collect_list(F.struct("first", "times", "id", "leaf", "changed"))).alias("entries")  # at most SPAN
    )
    repeated = F.transform(
        "entries", lambda e: F.array_repeat(F.struct(e["id"].alias("id"), e["leaf"].alias("leaf"), e["changed"].alias("changed")), e["times"])
    )
    rows = entries.select("tree", "seg", "n", F.flatten(repeated).alias("rows"))
    trees = _upper(_stored(rows.select("*", F.col("rows.leaf").alias("base")), "merkle-0"), "merkle")

    subroots = materialize(_roots(trees), "subroots")
    numbered = row_index(subroots, ["tree"], name="pos", total="n")
    tops = numbered.groupBy(F.floor(F.col("pos") / SPAN).alias("seg"), "n").agg(
        F.array_sort(F.collect_list(F.struct("pos", "digest"))).alias("nodes")
    )
    tops = tops.select(F.lit("").alias("tree"), "seg", "n", F.col("nodes.digest").alias("base"))
    top = _upper(_stored(tops, "merkle-top-0"), "merkle-top")
    root = _roots(top).first()
    if root is None:
        return leaves.select("id", "leaf", "changed", F.lit("").alias("subroot"), F.lit("").alias("root"), _no_path().alias("proof"))
    asked = numbered.select("tree", F.col("digest").alias("subroot"), "pos", "n", F.lit(root.digest).alias("digest"), _no_path().alias("path"))
    led = materialize(descend(asked, top).select("tree", "subroot", F.col("path").alias("path"), "digest"), "subroot-paths")

    bottom = trees[0].select("tree", "seg", "n")
    below = bottom.join(led, "tree").select("tree", "seg", "n", "subroot", "path", "digest", (F.col("seg") * SPAN).alias("pos"))
    below = descend(below, trees, 1).select("tree", "seg", "subroot", "path", F.col("digest").alias("node"))
    bottom = trees[0].join(below, ["tree", "seg"]).where(F.col("digest") == F.col("node"))
    proofs = F.transform(
        "rows",
        lambda r, i: F.struct(
            r["id"].alias("id"),
            r["leaf"].alias("leaf"),
            r["changed"].alias("changed"),
            F.reverse(F.concat(F.col("path"), _segment(F.col("levels"), i))).alias("proof"),
        ),
    )
    out = bottom.select("subroot", F.explode(proofs).alias("r"))
    return out.select("r.id", "r.leaf", "r.changed", "subroot", F.lit(root.digest).alias("root"), "r.proof")


def _no_path() -> Column:
    return F.array().cast("array<struct<before:string,after:string>>")


def folded(leaf: Column, proof: Column) -> Column:
    """The root that a leaf and its proof give."""
    return F.aggregate(proof, leaf, lambda at, s: F.sha2(F.concat(s["before"], at, s["after"]), 256))


def proof_digest(proof: Column) -> Column:
    return F.sha2(F.array_join(F.transform(proof, lambda s: F.concat(s["before"], s["after"])), ""), 256)


def manifest(docs: DataFrame, fields: Sequence[str] = FIELDS, id_col: str = "doc_id", tree_col: str = "source", changed: Column | None = None) -> DataFrame:
    """(id, leaf, changed, subroot, root, proof) of every record of ``docs``, see :func:`prove`.

    A leaf is the digest of ``fields`` in that order. ``changed`` is the digest to be checked against
    the root (the leaf itself by default). Nulls count as values of their own everywhere: a null group
    is a tree, the first one. Columns beside the fields are not read.
    """
    leaf = record_digest(*[F.col(f"`{c}`") for c in fields])
    tree = F.coalesce(F.concat(F.lit("+"), F.col(tree_col).cast("string")), F.lit(""))
    rows = docs.select(tree.alias("tree"), F.col(id_col).alias("id"), leaf.alias("leaf"), (leaf if changed is None else F.coalesce(changed, leaf)).alias("changed"))
    return prove(rows)


_RECORD = " || ".join(f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')" for c in FIELDS)
_UP = "string_agg(digest, '' ORDER BY pos)"
_KIDS = "list(digest ORDER BY pos) AS kids"
_FOLD = """sha256(array_to_string(kids[1:pos % 3], '') || acc || array_to_string(kids[pos % 3 + 2:], '')),
       proof || array_to_string(kids[1:pos % 3], '') || array_to_string(kids[pos % 3 + 2:], '')"""

SQL = f"""WITH RECURSIVE
crcs AS (SELECT list(list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, b: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS crcs
         FROM range(256) t(i)),
leaves AS (
  SELECT row_number() OVER () AS rid, doc_id, source, leaf,
         CASE WHEN xor(list_reduce([4294967295] || list_transform(string_split(doc_id::VARCHAR, ''), lambda d: ascii(d)::BIGINT),
                                   lambda c, b: xor(c >> 8, crcs[(xor(c, b) & 255) + 1])), 4294967295) % 2 = 0 THEN changed ELSE leaf END AS changed,
         row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n
  FROM (SELECT doc_id, source, sha256({_RECORD}) AS leaf,
               sha256({_RECORD.replace("text::", "replace(text, chr(10), '')::")}) AS changed FROM documents), crcs),
nodes AS (
  SELECT source, 0 AS lvl, pos, leaf AS digest, n FROM leaves
  UNION ALL
  SELECT source, lvl + 1, pos // 3, sha256({_UP}), (n + 2) // 3 FROM nodes WHERE n > 1 GROUP BY source, lvl, pos // 3, n),
runs AS (SELECT source, lvl, pos // 3 AS run, {_KIDS} FROM nodes WHERE n > 1 GROUP BY source, lvl, pos // 3),
fold AS (
  SELECT rid, source, 0 AS lvl, pos, n, changed AS acc, '' AS proof FROM leaves
  UNION ALL
  SELECT rid, f.source, f.lvl + 1, pos // 3, (n + 2) // 3, {_FOLD}
  FROM fold f JOIN runs r ON f.source IS NOT DISTINCT FROM r.source AND f.lvl = r.lvl AND pos // 3 = r.run WHERE n > 1),
subroots AS (SELECT source, digest, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM nodes WHERE n = 1),
tops AS (
  SELECT 0 AS lvl, pos, digest, n FROM subroots
  UNION ALL
  SELECT lvl + 1, pos // 3, sha256({_UP}), (n + 2) // 3 FROM tops WHERE n > 1 GROUP BY lvl, pos // 3, n),
topruns AS (SELECT lvl, pos // 3 AS run, {_KIDS} FROM tops WHERE n > 1 GROUP BY lvl, pos // 3),
topfold AS (
  SELECT rid, 0 AS lvl, s.pos, s.n, acc, proof FROM fold f JOIN subroots s ON f.source IS NOT DISTINCT FROM s.source WHERE f.n = 1
  UNION ALL
  SELECT rid, f.lvl + 1, pos // 3, (n + 2) // 3, {_FOLD}
  FROM topfold f JOIN topruns r ON f.lvl = r.lvl AND pos // 3 = r.run WHERE n > 1)
SELECT doc_id, leaf, s.digest AS subroot, t.digest AS root, sha256(proof) AS proof_sha256, acc AS folded_root, acc = t.digest AS verified
FROM leaves l JOIN topfold f ON l.rid = f.rid AND f.n = 1 JOIN subroots s ON l.source IS NOT DISTINCT FROM s.source JOIN tops t ON t.n = 1"""


@query("op13_merkle_manifest", SQL)
def op13_merkle_manifest(spark, sf_dir):
    docs = read(spark, sf_dir, "documents")
    tampered = record_digest(*[F.replace(F.col(c), F.lit("\n"), F.lit("")) if c == "text" else F.col(c) for c in FIELDS])
    even = F.crc32(F.encode(F.col("doc_id").cast("string"), "UTF-8")) % 2 == 0
    proved = manifest(docs, changed=F.when(even, tampered))
    return proved.select(
        F.col("id").alias("doc_id"),
        "leaf",
        "subroot",
        "root",
        proof_digest(F.col("proof")).alias("proof_sha256"),
        folded(F.col("changed"), F.col("proof")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))
