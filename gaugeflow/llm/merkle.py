"""Merkle manifest of a table: a digest per row, a tree per group of rows, one
root, and for every row the siblings that prove it belongs to the root.

A row's leaf is the SHA-256 of its columns. Inside a group the leaves stand in
the order of their key; while more than one node remains, each run of 16
consecutive ones becomes its SHA-256. What remains is the group's subroot, and
the subroots in the order of their groups give the root by the same rule.

Each level is a table of nodes (group, place, digest, nodes of the group). Over
the nodes of a run, lag and lead columns at the fixed offsets 1 to 15, masked
by the node's slot and the run's length, supply its siblings. The first child's
row has its whole run in its lead columns: it hashes the parent, and the first
children are the rows of the next level. On the way back every node takes its
parent's path and puts its own siblings in front of it. A row holds the nodes
of one run; a tree of n leaves has log16(n) levels, each a sixteenth of the one
below.

The place of a leaf in its group is a rank over range partitions: the sorted
table is written, each partition knows how many leaves of the group come before
it, and a group with a third of all rows is spread over many tasks.

Defined results:

* a null column counts as ``-`` in the leaf, any other as its number of UTF-8
  bytes, a colon and the value; so null and empty text differ;
* groups in bytewise order, null first; keys ascend, null first;
* rows of one group and key stand in the order of their leaves; equal rows have
  equal leaves and each has its own place and siblings;
* a lone leaf is its group's subroot, a lone subroot the root: neither has
  siblings there, and no hash is taken;
* a run may be one node long: its parent is the hash of that one digest;
* empty table: no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gaugeflow.llm.common import lower_ascii, stage

FANOUT = 16
NO_PATH = "array<struct<l:string,r:string>>"


def leaf_digest(*columns: Column) -> Column:
    """Digest of a row; integers are written in decimals."""
    fields = []
    for c in columns:
        value = c.cast("string")
        fields.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*fields), 256)


def _placed(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """``rows``, a written table, with ``pos`` (place in the group ``g``, from
    0) and ``n`` (rows of the group)."""
    # Equal rows have the same keys; the row number lets them part. Files are
    # read in the same order again if a task is lost.
    keys = ["g", *[F.col(c).asc_nulls_first() for c in order], "tie"]
    sorted_rows = rows.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    ranked = stage(sorted_rows.drop("tie").withColumns({
        "part": F.spark_partition_id(), "at": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))}), name)
    runs = ranked.groupBy("g", "part").agg(F.count("*").alias("_n"), F.min("at").alias("_lo"))
    group = Window.partitionBy("g")
    runs = stage(runs.select(
        "g", "part", (F.sum("_n").over(group.orderBy("part")) - F.col("_n") - F.col("_lo")).alias("shift"),
        F.sum("_n").over(group).alias("n")), f"{name}-runs")
    return ranked.join(runs, ["g", "part"]).withColumn("pos", F.col("at") + F.col("shift")).drop("part", "at", "shift")


def _with_siblings(nodes: DataFrame) -> DataFrame:
    """Nodes (``g``, ``pos``, ``n``, ``digest``) with ``run``, ``slot``, the
    siblings to the left ``l`` and right ``r`` as one text each."""
    run = F.floor(F.col("pos") / FANOUT)
    nodes = nodes.withColumns({"run": run, "slot": F.col("pos") % FANOUT,
                               "run_length": F.least(F.lit(FANOUT), F.col("n") - run * FANOUT)})
    order = Window.partitionBy("g", "run").orderBy("pos")
    left = [F.when(F.col("slot") >= k, F.lag("digest", k).over(order)) for k in range(FANOUT - 1, 0, -1)]
    right = [F.when(F.col("slot") + k < F.col("run_length"), F.lead("digest", k).over(order)) for k in range(1, FANOUT)]
    return nodes.withColumns({f"l{k}": c for k, c in enumerate(left)} | {f"r{k}": c for k, c in enumerate(right)}).withColumns({
        "l": F.concat_ws("", *[f"l{k}" for k in range(FANOUT - 1)]),
        "r": F.concat_ws("", *[f"r{k}" for k in range(FANOUT - 1)]),
    }).drop("run_length", *[f"{x}{k}" for x in "lr" for k in range(FANOUT - 1)])


def _climb(leaves: DataFrame, name: str) -> list[DataFrame]:
    """The levels above ``leaves`` (placed), as written tables of ``g``,
    ``pos``, ``n`` and ``digest``. A group whose last node is reached has no
    rows in the levels above."""
    levels = []
    nodes = leaves.select("g", "pos", "n", "digest")
    most = leaves.agg(F.max("n")).first()[0] or 0
    while most > 1:
        first = _with_siblings(nodes.where(F.col("n") > 1)).where(F.col("slot") == 0)
        nodes = stage(first.select("g", F.col("run").alias("pos"), F.ceil(F.col("n") / FANOUT).alias("n"),
                                   F.sha2(F.concat("digest", "r"), 256).alias("digest")), f"{name}-level{len(levels) + 1}")
        levels.append(nodes)
        most = -(-most // FANOUT)
    return levels


def _subroots(leaves: DataFrame, levels: list[DataFrame]) -> DataFrame:
    tops = [x.where(F.col("n") == 1).select("g", "digest") for x in (leaves, *levels)]
    out = tops[0]
    for t in tops[1:]:
        out = out.unionByName(t)
    return out


def _descend(leaves: DataFrame, levels: list[DataFrame], tops: DataFrame, name: str) -> DataFrame:
    """``leaves`` with ``path``: the siblings from its own level up to the
    root, as left and right texts per level. ``tops`` has the path of every
    group's last node and further columns, which come along."""
    carried = [c for c in tops.columns if c != "g"]
    above = None
    for depth in range(len(levels), -1, -1):
        nodes = levels[depth - 1] if depth else leaves
        # A group's last node has no siblings: its path is the group's.
        found = nodes.where(F.col("n") == 1).join(tops, "g").select(*nodes.columns, *carried)
        if above is not None:
            below = _with_siblings(nodes.where(F.col("n") > 1)).join(above, ["g", "run"])
            path = F.concat(F.array(F.struct("l", "r")), "path").alias("path")
            found = found.unionByName(below.select(*nodes.columns, *[path if c == "path" else c for c in carried]))
        if depth:
            above = stage(found.select("g", F.col("pos").alias("run"), *carried), f"{name}-paths{depth}")
    return found


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings give."""
    return F.aggregate(path, leaf, lambda node, x: F.sha2(F.concat(x["l"], node, x["r"]), 256))


def proof_text(path: Column) -> Column:
    """All siblings, level by level, left to right."""
    return F.array_join(F.transform(path, lambda x: F.concat(x["l"], x["r"])), "")


def manifest(rows: DataFrame, key: str, group: str, columns: list[str], tampered: dict[str, Column] | None = None) -> DataFrame:
    """A row per row of ``rows``: ``key``, ``group``, ``leaf``, ``subroot``,
    ``root`` and ``path``. ``tampered`` gives other values for some columns;
    ``seen_leaf`` is then the leaf of the row with them."""
    changed = [(tampered or {}).get(c, F.col(c)) for c in columns]
    leaves = stage(rows.select(
        F.col(key).alias("key"), F.coalesce(F.concat(F.lit("1"), F.col(group).cast("string")), F.lit("0")).alias("g"), leaf_digest(*[F.col(c) for c in columns]).alias("digest"),
        leaf_digest(*changed).alias("seen_leaf")), "merkle-leaves")
    placed = stage(_placed(leaves, ["key", "digest"], "merkle-placed"), "merkle-leaves-placed")
    levels = _climb(placed, "merkle")
    roots = stage(_subroots(placed, levels).select(F.lit("").alias("g"), F.col("g").alias("of"), "digest"), "merkle-subroots")
    groups = stage(_placed(roots, ["of"], "merkle-groups"), "merkle-groups-placed")
    group_levels = _climb(groups, "merkle-groups")
    top = _subroots(groups, group_levels).select("g", F.col("digest").alias("root"), F.array().cast(NO_PATH).alias("path"))
    paths = _descend(groups, group_levels, top, "merkle-groups")
    tops = stage(paths.select(F.col("of").alias("g"), F.col("digest").alias("subroot"), "root", "path"), "merkle-tops")
    return _descend(placed, levels, tops, "merkle").select(
        F.col("key").alias(key), F.when(F.col("g") != "0", F.expr("substring(g, 2)")).alias(group),
        F.col("digest").alias("leaf"), "seen_leaf", "subroot", "root", "path")


COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]


def dataset_manifest(documents: DataFrame) -> DataFrame:
    """The manifest of ``documents`` by source, with the check of a tampered
    copy: where five divides the CRC-32 of the decimal doc_id, the copy's text
    is in lower case (A-Z only; a null doc_id has no CRC and is not changed)."""
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    rows = manifest(documents, "doc_id", "source", COLUMNS,
                    {"text": F.when(hit, lower_ascii(F.col("text"))).otherwise(F.col("text"))})
    return rows.select(
        "doc_id", "leaf", "subroot", "root", F.sha2(proof_text(F.col("path")), 256).alias("proof_sha256"),
        fold(F.col("seen_leaf"), F.col("path")).alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))


def _tree_sql(prefix: str, leaves: str, levels: int) -> str:
    """Common table expressions of the levels ``<prefix>0`` and up, with the
    siblings ``<prefix>s0`` and up, over ``leaves`` (g, pos, n, digest)."""
    out = [f"{prefix}0 AS (SELECT g, pos, n, digest FROM {leaves})"]
    for k in range(levels):
        out.append(f"""{prefix}s{k} AS (
  SELECT a.g, a.pos, a.n, coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos < a.pos), '') AS l,
         coalesce(string_agg(b.digest, '' ORDER BY b.pos) FILTER (b.pos > a.pos), '') AS r
  FROM {prefix}{k} a JOIN {prefix}{k} b ON a.g = b.g AND a.pos // 16 = b.pos // 16 GROUP BY a.g, a.pos, a.n),
{prefix}{k + 1} AS (
  SELECT g, pos // 16 AS pos, (any_value(n) + 15) // 16 AS n,
         CASE WHEN any_value(n) = 1 THEN any_value(digest) ELSE sha256(string_agg(digest, '' ORDER BY pos)) END AS digest
  FROM {prefix}{k} GROUP BY g, pos // 16)""")
    return ",\n".join(out)


def _fold_sql(prefix: str, start: str, g: str, pos: str, levels: int) -> str:
    """Expressions over the joined siblings: a chain of lateral columns."""
    joins = " ".join(f"JOIN {prefix}s{k} {prefix}x{k} ON {prefix}x{k}.g = {g} AND {prefix}x{k}.pos = {pos} // {16 ** k}"
                     for k in range(levels))
    proof = " || ".join(f"{prefix}x{k}.l || {prefix}x{k}.r" for k in range(levels))
    node = start
    for k in range(levels):
        joins += f" CROSS JOIN LATERAL (SELECT {node} AS f) {prefix}y{k}"
        node = f"CASE WHEN {prefix}x{k}.n = 1 THEN {prefix}y{k}.f ELSE sha256({prefix}x{k}.l || {prefix}y{k}.f || {prefix}x{k}.r) END"
    return joins + f" CROSS JOIN LATERAL (SELECT {node} AS folded, {proof} AS proof) {prefix}z"


def oracle_sql(levels: int = 5) -> str:
    """The rows of :func:`dataset_manifest` for groups of up to 16**levels
    leaves, and as many groups."""
    def digest(text: str) -> str:
        fields = [text if c == "text" else f"{c}::VARCHAR" for c in COLUMNS]
        return "sha256(" + " || ".join(f"coalesce(strlen({c}) || ':' || {c}, '-')" for c in fields) + ")"

    crc = ("xor(list_reduce([ascii(x)::BIGINT FOR x IN string_split(doc_id::VARCHAR, '')], lambda c, b: "
           "list_reduce(range(8), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END, xor(c, b)), "
           "4294967295::BIGINT), 4294967295)")
    lowered = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return f"""
WITH rows AS (
  SELECT doc_id, coalesce('1' || source, '0') AS g, {digest("text")} AS digest,
         {digest(f"CASE WHEN coalesce({crc} % 5 = 0, false) THEN {lowered} ELSE text END")} AS seen
  FROM documents),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, digest) - 1 AS pos, count(*) OVER (PARTITION BY g) AS n
  FROM rows),
{_tree_sql("t", "leaves", levels)},
subroots AS (SELECT '' AS g, g AS grp, digest, row_number() OVER (ORDER BY g) - 1 AS pos, count(*) OVER () AS n FROM t{levels}),
{_tree_sql("u", "subroots", levels)},
folded AS (
  SELECT leaves.doc_id, leaves.g, leaves.digest, tz.folded, tz.proof
  FROM leaves {_fold_sql("t", "leaves.seen", "leaves.g", "leaves.pos", levels)})
SELECT folded.doc_id, folded.digest AS leaf, subroots.digest AS subroot, u{levels}.digest AS root,
       sha256(folded.proof || uz.proof) AS proof_sha256, uz.folded AS folded_root, uz.folded = u{levels}.digest AS verified
FROM folded JOIN subroots ON subroots.grp = folded.g CROSS JOIN u{levels}
{_fold_sql("u", "folded.folded", "''", "subroots.pos", levels)}
"""


ORACLE_SQL = oracle_sql()
