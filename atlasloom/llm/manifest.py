"""A Merkle manifest of a dataset, and the climb from every leaf to its root by a recursive query.

``H`` is SHA-256 in lower-case hexadecimal; its inputs are concatenated, digests as their hexadecimal text. A leaf hashes the fields of
a row, each ``-`` if null, else its number of UTF-8 bytes, a colon and its value. Leaves of a source ascend by ``doc_id``
(null first, equal ones by leaf); three neighbours at a time become their ``H`` until one node, the subroot, remains; subroots in the order of
their source (null first, then by bytes) become the root in the same way.

Built levels are stored as rows ``node, parent, left, right``: the links to the parent, and what lies beside the node in its run of three.
``climb`` starts with one row for each leaf and ascends these links in a recursive query: each step appends the siblings and folds
them into the digest. The result has a row for each leaf and level, so a step carries a digest and never a growing list.

A node's number is the position of its first leaf and its level. From ``SHARED`` levels up the same node would be asked for by very many
leaves, so there a node has a copy for every block of ``3 ** SHARED`` leaves below it (N / 243 rows a level): no key is joined by more leaves
than a block has, however large the source. Tables are written to the shared folder; nothing but their sizes reaches the driver.

An empty table gives no rows. Rows that are repeated are leaves of their own. Further columns are not read.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from atlasloom.llm.common import written
from atlasloom.operators.positions import number_rows
from atlasloom.sizing import broadcast_if_small, settle_by_key

RUN = 3
#: Levels whose nodes are stored once; a block has ``RUN ** SHARED`` leaves.
SHARED = 5
#: Blocks that one row is copied for at a time.
COPIES = 4096
#: The level is kept in the low bits of a node's number: trees have fewer than 64 levels.
_LEVELS = 64

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def field(value: Column) -> Column:
    """``-`` for null, else number of UTF-8 bytes, colon, value."""
    body = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(body).cast("string"), F.lit(":"), body), F.lit("-"))


def leaf_digest(fields: dict[str, Column]) -> Column:
    return F.unhex(F.sha2(F.concat(*[field(c) for c in fields.values()]).cast("binary"), 256))


def text_of(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def fold(*digests: Column) -> Column:
    """``H`` of concatenated binary digests, binary itself."""
    return F.unhex(F.sha2(text_of(F.concat(*digests)).cast("binary"), 256))


def tampered_text() -> Column:
    """The text without its line feeds where the checksum of ``doc_id`` is even; null stays, and null ids are left alone."""
    chosen = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.lit(False))
    return F.when(chosen, F.translate("text", "\n", "")).otherwise(F.col("text"))


def leaves(docs: DataFrame) -> tuple[DataFrame, int]:
    """``row, first, n, tree, doc_id, leaf, changed`` of every row, and their number.

    ``row`` is the position over all sources, ``first`` that of the source's first leaf, ``n`` its number of leaves,
    ``tree`` the place of the source among the sources; ``changed`` is the digest after tampering.
    """
    plain = {c: F.col(c) for c in FIELDS}
    slim = docs.select("doc_id", "source", leaf_digest(plain).alias("leaf"), leaf_digest({**plain, "text": tampered_text()}).alias("changed"))
    slim = written(slim, "leaves")  # hashed once: dealing by ranges reads its rows twice
    order = [F.col("source").asc_nulls_first(), F.col("doc_id").asc_nulls_first(), F.col("leaf")]
    numbered, rows = number_rows(slim, order, "row")
    numbered = written(numbered, "numbered")
    sources = written(numbered.groupBy("source").agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("n")), "sources")
    ranked, _ = number_rows(sources, [F.col("first")], "tree")
    ranked = broadcast_if_small(ranked.withColumnRenamed("source", "__source"))
    joined = numbered.join(ranked, F.col("source").eqNullSafe(F.col("__source")))
    return joined.select("row", "first", "n", "tree", "doc_id", "leaf", "changed"), rows


def _joined(members: Column) -> Column:
    return F.aggregate(members, F.lit(b""), lambda a, m: F.concat(a, m["digest"]))


def grow(nodes: DataFrame, largest: int) -> tuple[list[DataFrame], DataFrame]:
    """All trees at once, level by level, and their roots (``tree, first, n, height, digest``).

    ``nodes`` has ``tree, first, n, place, digest``: a tree's number, the position of its first leaf, its number of leaves (``largest``
    at most). A level has ``tree, first, n, place, digest, left, right``, the last two being what lies beside a node in its run; roots
    are in none. A level is one grouping of three rows at most, over a third of the rows of the one below.
    """
    columns = ["tree", "first", "n", "place", "digest"]
    levels: list[DataFrame] = []
    current = nodes.select(*columns, F.col("n").alias("size"))
    roots = [current.filter("size = 1")]
    while RUN ** len(levels) < largest:
        runs = written(current.filter("size > 1").groupBy("tree", F.floor(F.col("place") / RUN).alias("run")).agg(
            *[F.first(c).alias(c) for c in ("first", "n", "size")],
            F.array_sort(F.collect_list(F.struct("place", "digest"))).alias("members")), f"level-{len(levels)}")
        beside = runs.select("*", F.posexplode("members").alias("at", "member"))
        levels.append(beside.select(
            "tree", "first", "n", F.col("member.place").alias("place"), F.col("member.digest").alias("digest"),
            _joined(F.expr("slice(members, 1, at)")).alias("left"), _joined(F.expr("slice(members, at + 2, 3)")).alias("right")))
        current = runs.select("tree", "first", "n", F.col("run").alias("place"), fold(_joined(F.col("members"))).alias("digest"),
                              F.ceil(F.col("size") / RUN).alias("size"))
        roots.append(current.filter("size = 1"))
    done = [r.select("tree", "first", "n", F.lit(k).alias("height"), "digest") for k, r in enumerate(roots)]
    for more in done[1:]:
        done[0] = done[0].unionByName(more)
    return levels, done[0]


def _spread(upper: DataFrame) -> DataFrame:
    """A copy of each row for every block from ``from_block`` to ``to_block``, dealt out in portions of ``COPIES``."""
    portions = upper.withColumn("portion", F.explode(F.sequence(F.floor(F.col("from_block") / COPIES), F.floor(F.col("to_block") / COPIES))))
    dealt = portions.repartition("tree", "level", "portion")
    return dealt.withColumn("block", F.explode(F.sequence(
        F.greatest("from_block", F.col("portion") * COPIES), F.least("to_block", F.col("portion") * COPIES + COPIES - 1))))


def _number(position: Column, level: Column) -> Column:
    return position * _LEVELS + level


def linked(trees: DataFrame, levels: list[DataFrame], over: list[DataFrame]) -> DataFrame:
    """``node, parent, left, right, last``: all levels of the sources' trees (``levels``) and of the tree over them (``over``).

    ``last`` marks the nodes whose parent is the root.

    ``trees`` has a row per source: ``tree, first, n, height``.
    """
    block = RUN ** SHARED
    parts = []
    for k, rows in enumerate(levels):
        if k < SHARED:
            at = F.col("first") + F.col("place") * RUN ** k
            above = F.col("first") + F.floor(F.col("place") / RUN) * RUN ** (k + 1)
            parts.append(rows.select(_number(at, F.lit(k)).alias("node"), _number(above, F.lit(k + 1)).alias("parent"), "left", "right"))
        else:
            span = RUN ** (k - SHARED)
            last = F.floor((F.col("n") - 1) / block)
            parts.append(_copies(rows.select("tree", "first", F.lit(k).alias("level"), (F.col("place") * span).alias("from_block"),
                                             F.least((F.col("place") + 1) * span - 1, last).alias("to_block"), "left", "right")))
    for k, rows in enumerate(over):
        # what lies beside the ancestor of each source at this level, for all blocks of the source
        path = trees.withColumn("place", F.floor(F.col("tree") / RUN ** k)).join(rows.select("place", "left", "right"), "place")
        parts.append(_copies(path.select(
            "tree", "first", (F.col("height") + k).cast("int").alias("level"), F.lit(0).cast("long").alias("from_block"),
            F.floor((F.col("n") - 1) / block).alias("to_block"), "left", "right")))
    if not parts:  # a lone leaf is the root
        return trees.filter("1 = 0").select(F.col("first").alias("node"), F.col("first").alias("parent"), F.lit(b"").alias("left"),
                                            F.lit(b"").alias("right"), F.lit(True).alias("last"))
    marked = [part.withColumn("last", F.lit(i == len(parts) - 1)) for i, part in enumerate(parts)]
    for more in marked[1:]:
        marked[0] = marked[0].unionByName(more)
    return marked[0]


def _copies(upper: DataFrame) -> DataFrame:
    spread = _spread(upper)
    at = F.col("first") + F.col("block") * RUN ** SHARED
    return spread.select(_number(at, F.col("level")).alias("node"), _number(at, F.col("level") + 1).alias("parent"), "left", "right")


def climb(starts: DataFrame, nodes: DataFrame, finish: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """What ``finish`` makes of the climb, written: ``row, node, digest, siblings, last`` of each leaf and each node above it.

    ``starts`` has ``row, digest``. A recursive query over the links: the first row of a leaf is itself, without siblings; the last has
    the root that its digest folds to. Its steps are not stored but read by ``finish`` alone.
    """
    spark = starts.sparkSession
    tag = uuid.uuid4().hex[:12]
    starts.createOrReplaceTempView(f"starts_{tag}")
    nodes.createOrReplaceTempView(f"nodes_{tag}")
    limit = "spark.sql.cteRecursionRowLimit"  # a guard against endless recursion; the climb ends where no parent is
    before = spark.conf.get(limit, None)
    spark.conf.set(limit, "-1")
    try:
        return written(finish(spark.sql(f"""
            WITH RECURSIVE climb(row, node, digest, siblings, last) AS (
              SELECT row, row * {_LEVELS}, digest, X'', false FROM starts_{tag}
              UNION ALL
              SELECT c.row, n.parent, unhex(sha2(CAST(lower(hex(concat(n.left, c.digest, n.right))) AS BINARY), 256)),
                concat(n.left, n.right), n.last
              FROM climb c JOIN nodes_{tag} n ON c.node = n.node)
            SELECT * FROM climb""")), "climb")
    finally:
        if before is None:
            spark.conf.unset(limit)
        else:
            spark.conf.set(limit, before)
        spark.catalog.dropTempView(f"starts_{tag}")
        spark.catalog.dropTempView(f"nodes_{tag}")


def proofs(steps: DataFrame) -> DataFrame:
    """``row, proof_sha256, folded_root`` (null for a lone leaf) from the steps of a climb; a row's group has a row for each level."""
    step = F.struct(F.col("node").bitwiseAND(F.lit(_LEVELS - 1)).alias("level"), "siblings", F.when(F.col("last"), F.col("digest")).alias("digest"))
    return steps.groupBy("row").agg(F.array_sort(F.collect_list(step)).alias("steps")).select(
        "row", F.sha2(text_of(F.aggregate("steps", F.lit(b""), lambda a, s: F.concat(a, s["siblings"]))).cast("binary"), 256).alias("proof_sha256"),
        text_of(F.element_at("steps", -1)["digest"]).alias("folded_root"))


def manifest(docs: DataFrame) -> DataFrame:
    """``doc_id, leaf, subroot, root, proof_sha256, folded_root, verified, row, source_rows`` of every row.

    ``proof_sha256`` is ``H`` of the siblings from the leaf to the root; ``folded_root`` folds the tampered leaf with the original
    siblings, and ``verified`` tells whether that is the root.
    """
    found, rows = leaves(docs)
    if not rows:
        return found.select("doc_id", *[F.lit("").alias(c) for c in ("leaf", "subroot", "root", "proof_sha256", "folded_root")],
                            F.lit(True).alias("verified"), "row", F.col("n").alias("source_rows"))
    found = written(found, "numbered")
    largest = found.agg(F.max("n")).first()[0]
    levels, done = grow(found.select("tree", "first", "n", (F.col("row") - F.col("first")).alias("place"), F.col("leaf").alias("digest")), largest)
    subroots = written(done.withColumnRenamed("digest", "subroot"), "subroots")
    sources = subroots.count()
    zero = F.lit(0).cast("long")
    over, top = grow(subroots.select(zero.alias("tree"), zero.alias("first"), F.lit(sources).cast("long").alias("n"), F.col("tree").alias("place"),
                                     F.col("subroot").alias("digest")), sources)
    root = text_of(F.lit(bytes(top.first()["digest"])))
    nodes = settle_by_key(linked(subroots.drop("subroot"), levels, over).repartition("node"), "node")
    paths = climb(found.select("row", F.col("changed").alias("digest")), nodes, proofs)
    below = broadcast_if_small(subroots.select("tree", text_of(F.col("subroot")).alias("subroot")))
    out = found.join(paths, "row").join(below, "tree").withColumn("folded_root", F.coalesce("folded_root", text_of(F.col("changed"))))
    return out.select("doc_id", text_of(F.col("leaf")).alias("leaf"), "subroot", root.alias("root"), "proof_sha256", "folded_root",
                      (F.col("folded_root") == root).alias("verified"), "row", F.col("n").alias("source_rows"))


#: CRC-32 of a short ASCII string, bit by bit.
def _crc_sql(text: str) -> str:
    step = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
    return (f"xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({text}, ''), lambda ch: ascii(ch)::BIGINT)), "
            f"lambda a, b: list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda c, z: {step})), 4294967295::BIGINT)")


MANIFEST_SQL = f"""
WITH RECURSIVE f AS (SELECT doc_id, source, concat({', '.join(
    f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')" for c in FIELDS[:-1])}) AS head, text,
  CASE WHEN {_crc_sql("doc_id::VARCHAR")} % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS cut FROM documents),
d AS (SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
  sha256(head || coalesce(strlen(cut) || ':' || cut, '-')) AS changed FROM f),
l AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY source NULLS FIRST, doc_id NULLS FIRST, leaf) - 1 AS row,
  dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
  row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, count(*) OVER (PARTITION BY source) AS n FROM d),
t(level, tree, place, size, digest) AS (
  SELECT 0, tree, place, n, leaf FROM l
  UNION ALL SELECT any_value(level) + 1, tree, place // 3, any_value((size + 2) // 3), sha256(string_agg(digest, '' ORDER BY place))
    FROM t WHERE size > 1 GROUP BY tree, place // 3),
s AS (SELECT tree, level AS height, digest FROM t WHERE size = 1),
o(level, place, size, digest) AS (
  SELECT 0, tree, (SELECT count(*) FROM s), digest FROM s
  UNION ALL SELECT any_value(level) + 1, place // 3, any_value((size + 2) // 3), sha256(string_agg(digest, '' ORDER BY place))
    FROM o WHERE size > 1 GROUP BY place // 3),
b AS (SELECT *, coalesce(string_agg(digest, '') OVER (PARTITION BY level, tree, place // 3 ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS lft,
  coalesce(string_agg(digest, '') OVER (PARTITION BY level, tree, place // 3 ORDER BY place ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS rgt
  FROM (SELECT level, tree, place, size, digest FROM t UNION ALL SELECT level, -1, place, size, digest FROM o) WHERE size > 1),
c(row, tree, top, level, place, digest, proof) AS (
  SELECT row, tree, tree, 0, place, changed, '' FROM l
  UNION ALL SELECT c.row, CASE WHEN b.tree IS NULL THEN -1 ELSE c.tree END, c.top, CASE WHEN b.tree IS NULL THEN 0 ELSE c.level + 1 END,
    CASE WHEN b.tree IS NULL THEN c.top ELSE c.place // 3 END,
    CASE WHEN b.tree IS NULL THEN c.digest ELSE sha256(b.lft || c.digest || b.rgt) END, c.proof || coalesce(b.lft || b.rgt, '')
  FROM c LEFT JOIN b ON b.tree = c.tree AND b.level = c.level AND b.place = c.place WHERE b.tree IS NOT NULL OR c.tree >= 0),
e AS (SELECT row, digest, proof, row_number() OVER (PARTITION BY row ORDER BY (tree < 0) DESC, level DESC) AS nth FROM c)
SELECT doc_id, leaf, s.digest AS subroot, r.digest AS root, sha256(proof) AS proof_sha256, e.digest AS folded_root, e.digest = r.digest AS verified,
  l.row, l.n AS source_rows
FROM l JOIN e ON e.row = l.row AND nth = 1 JOIN s ON s.tree = l.tree, (SELECT digest FROM o WHERE size = 1) r"""
