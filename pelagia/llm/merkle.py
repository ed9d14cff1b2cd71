"""A Merkle manifest of a dataset: leaf digests, a tree for each source, one root, and a proof for every row.

H is the lowercase hex sha256 of its inputs put together. A row's leaf is H of its fields, each written as byte count, colon and value ("-" where
null). The leaves of a source ascend by doc_id; while there are several nodes, every RUN consecutive ones (the last run may be
shorter, down to one) become their H; what remains is the source's subroot. Subroots in order of their sources (null first, by UTF-8 bytes)
make the root the same way.

Spark gives every node its place in its group and cuts groups into aligned buckets of RUN * RUN places, so that a bucket's two levels need no
other bucket. Buckets are dealt by hash into blocks of about BLOCK nodes; an executor hands a block to DuckDB as an Arrow table, and one query for each level
(string_agg in order, then sha256) gives the buckets' roots, which are the nodes of the next round. A source that holds most of the rows is many
buckets, sources of one row each share blocks. Then the rounds are gone through backwards: each bucket's proof, found one round up, is joined to it,
and DuckDB puts the siblings inside the bucket before it. The driver sees one row for each task and each round, no digests but the root.

Equal ids of a source stand in order of their leaves; rows alike in all fields have neighbouring places and differ in their proofs. Null ids come
first. An empty table gives no rows. Columns other than the five fields and doc_id are not part of a leaf.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pelagia.llm.common import materialize, release

#: Nodes that become one, places of a bucket (two levels) and nodes that one DuckDB run takes, on average.
RUN = 16
BUCKET = RUN * RUN
BLOCK = 4096
#: What a row's leaf holds, in this order.
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def digest(fields: list[Column]) -> Column:
    """The leaf of a row."""
    written = []
    for f in fields:
        value = f.cast("string")
        written.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-")))
    return F.sha2(F.concat(*written), 256)


def _numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by grp, their grp in column 0: adds the number of the grp in this task, and the row's place in it."""
    run, at, last = -1, 0, None
    for batch in batches:
        if not batch.num_rows:
            continue
        grp = batch.column(0)
        a, b = grp.slice(0, len(grp) - 1), grp.slice(1)
        changed = pc.or_(pc.fill_null(pc.not_equal(a, b), False), pc.xor(pc.is_null(a), pc.is_null(b)))
        fresh = run < 0 or grp[0].as_py() != last
        cut = [fresh, *changed.to_pylist()]
        runs, places = [], []
        for c in cut:
            run, at = (run + 1, 0) if c else (run, at + 1)
            runs.append(run)
            places.append(at)
        last = grp[-1].as_py()
        yield pa.record_batch([*batch.columns, pa.array(runs, pa.int32()), pa.array(places, pa.int64())], names=[*batch.schema.names, "run", "at"])


def ranked(rows: DataFrame, *order: str) -> tuple[DataFrame, int]:
    """rows (first column grp) with rank, their place from 0 within the grp in that order, written; and how many there are.

    Ranges of the whole order are dealt out, so only the first grp of a task can have begun in earlier ones: one offset a task is enough.
    """
    keys = [F.col(c).asc_nulls_first() for c in ("grp", *order)]
    sorted_ = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    schema = rows.schema.simpleString()[7:-1] + ",run:int,at:bigint"
    placed = materialize(sorted_.mapInArrow(_numbered, schema).withColumn("part", F.spark_partition_id()))
    ends = placed.groupBy("part").agg(F.min(F.struct("run", "at", "grp")).alias("first"), F.max(F.struct("run", "at", "grp")).alias("last"), F.count("*").alias("n"))
    offsets, carry, before, total = [], 0, None, 0
    for r in sorted(ends.collect(), key=lambda r: r.part):  # a row for each task
        carry = carry if before is not None and before.grp == r.first.grp else 0
        offsets.append((r.part, carry))
        carry = r.last.at + 1 + (carry if r.last.run == 0 else 0)
        before, total = r.last, total + r.n
    if not offsets:
        return placed.select(*rows.columns, F.col("at").alias("rank")), 0
    table = rows.sparkSession.createDataFrame(offsets, "part int, offset long")
    rank = F.col("at") + F.when(F.col("run") == 0, F.col("offset")).otherwise(0)
    return placed.join(F.broadcast(table), "part").select(*rows.columns, rank.alias("rank")), total


_engine = []


def _duck(tables: dict[str, pa.Table], query: str, kind: pa.Schema) -> pa.Table:
    """One query over Arrow tables in this process' DuckDB, with one thread."""
    import duckdb

    if not _engine:
        _engine.append(duckdb.connect(config={"threads": 1, "memory_limit": "512MB"}))
    for name, table in tables.items():
        _engine[0].register(name, table)
    try:
        return _engine[0].sql(query).to_arrow_table().select(kind.names).cast(kind)
    finally:
        for name in tables:
            _engine[0].unregister(name)


#: Nodes with the count of their bucket. A whole group of one node has no level above it, one of at most RUN has one, all else two.
_LEVELS = f"""
n AS (SELECT *, rank // {BUCKET} AS bucket, rank // {RUN} AS run, count(*) OVER (PARTITION BY grp, rank // {BUCKET}) AS size FROM nodes),
one AS (SELECT grp, bucket, run, any_value(size) AS size, sha256(string_agg(hash, '' ORDER BY rank)) AS hash FROM n WHERE bucket > 0 OR size > 1 GROUP BY grp, bucket, run),
two AS (SELECT grp, bucket, any_value(size) AS size, sha256(string_agg(hash, '' ORDER BY run)) AS hash FROM one WHERE bucket > 0 OR size > {RUN} GROUP BY grp, bucket)
"""
_UP = f"""
WITH {_LEVELS}
SELECT grp, bucket AS rank, hash, size FROM two
UNION ALL SELECT grp, bucket, hash, size FROM one WHERE bucket = 0 AND size <= {RUN}
UNION ALL SELECT grp, bucket, hash, size FROM n WHERE bucket = 0 AND size = 1
"""
#: A step of a path is a node's siblings with a bar where the node itself goes.
_PATHS = f"""
WITH {_LEVELS},
low AS (SELECT *, coalesce(string_agg(hash, '') OVER before_, '') || '|' || coalesce(string_agg(hash, '') OVER after_, '') AS step FROM n
  WINDOW before_ AS (PARTITION BY grp, run ORDER BY rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         after_ AS (PARTITION BY grp, run ORDER BY rank ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)),
high AS (SELECT grp, bucket, run, coalesce(string_agg(hash, '') OVER before_, '') || '|' || coalesce(string_agg(hash, '') OVER after_, '') AS step FROM one
  WINDOW before_ AS (PARTITION BY grp, bucket ORDER BY run ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
         after_ AS (PARTITION BY grp, bucket ORDER BY run ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)),
path AS (SELECT low.*, o.subroot, CASE WHEN low.bucket = 0 AND low.size = 1 THEN o.path
    WHEN low.bucket = 0 AND low.size <= {RUN} THEN list_concat([low.step], o.path)
    ELSE list_concat([low.step, high.step], o.path) END AS path
  FROM low JOIN outer_ o ON low.grp IS NOT DISTINCT FROM o.grp AND low.bucket = o.rank
  LEFT JOIN high ON low.grp IS NOT DISTINCT FROM high.grp AND low.run = high.run)
"""
_DOWN = _PATHS + "SELECT grp, rank, path, subroot FROM path"
_PROOFS = (
    _PATHS
    + """SELECT doc_id, hash AS leaf, subroot, sha256(array_to_string(list_transform(path, lambda x: replace(x, '|', '')), '')) AS proof_sha256,
  list_reduce(list_concat([coalesce(tampered, hash)], path), lambda a, x: sha256(replace(x, '|', a))) AS folded_root FROM path"""
)
_S, _N = pa.string(), pa.int64()
_ROOTS = pa.schema([("grp", _S), ("rank", _N), ("hash", _S), ("size", _N)])
_PATH = pa.schema([("grp", _S), ("rank", _N), ("path", pa.list_(_S)), ("subroot", _S)])
_PROOF = pa.schema([("doc_id", _N), ("leaf", _S), ("subroot", _S), ("proof_sha256", _S), ("folded_root", _S)])


def _roots(nodes: pa.Table) -> pa.Table:
    return _duck({"nodes": nodes}, _UP, _ROOTS)


def _paths(nodes: pa.Table, outer: pa.Table) -> pa.Table:
    return _duck({"nodes": nodes, "outer_": outer}, _DOWN, _PATH)


def _proofs(nodes: pa.Table, outer: pa.Table) -> pa.Table:
    return _duck({"nodes": nodes, "outer_": outer}, _PROOFS, _PROOF)


def _block(bucket: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64("grp", bucket), F.lit(blocks)).alias("block")


def _bucket() -> Column:
    return F.floor(F.col("rank") / BUCKET).cast("long")


def tree(nodes: DataFrame, total: int) -> tuple[list[tuple[DataFrame, DataFrame, int]], DataFrame | None]:
    """Rounds from the leaves up, each (nodes, roots of their buckets, number of blocks), and grp, hash of every finished group.

    nodes: grp, rank, hash and whatever else a leaf carries.
    """
    rounds, finished = [], None
    while total:
        blocks = -(-total // BLOCK)
        roots = nodes.select("grp", "rank", "hash").groupBy(_block(_bucket(), blocks)).applyInArrow(_roots, "grp string, rank long, hash string, size long")
        roots = materialize(roots.withColumn("done", (F.col("rank") == 0) & (F.col("size") < BUCKET)))
        rounds.append((nodes, roots, blocks))
        done = roots.where("done").select("grp", "hash")
        finished = done if finished is None else finished.union(done)
        nodes = roots.where("NOT done").select("grp", "rank", "hash")
        total = nodes.count()
    return rounds, finished


def descend(rounds: list[tuple[DataFrame, DataFrame, int]], tops: DataFrame, last=_paths, kind: str = "grp string, rank long, path array<string>, subroot string") -> DataFrame:
    """What `last` makes of the leaves and the outer proofs of their buckets; tops: grp, path and subroot of every finished group."""
    above = None
    tops = tops.withColumnRenamed("grp", "__grp")
    for i in range(len(rounds) - 1, -1, -1):
        nodes, roots, blocks = rounds[i]
        ended = roots.where("done").select("grp", "rank")
        outer = ended.join(tops, ended["grp"].eqNullSafe(tops["__grp"])).select("grp", "rank", "path", "subroot")
        outer = outer if above is None else outer.unionByName(above)
        make, schema = (last, kind) if i == 0 else (_paths, "grp string, rank long, path array<string>, subroot string")
        left = nodes.groupBy(_block(_bucket(), blocks))
        above = left.cogroup(outer.groupBy(_block(F.col("rank"), blocks))).applyInArrow(make, schema)
        if i:
            above = materialize(above)
    return above


def manifest(docs: DataFrame, tampered: Column | None = None) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified, for every row.

    tampered: the leaf that a row is checked with, where not null, in place of its own (a digest of what was found in the store, say). verified
    tells whether that leaf and the row's proof lead to the root.
    """
    leaves = docs.select(F.col("source").alias("grp"), F.col("doc_id").cast("long").alias("doc_id"), digest([F.col(f) for f in FIELDS]).alias("hash"), (tampered if tampered is not None else F.lit(None).cast("string")).alias("tampered"))
    leaves = materialize(leaves.withColumn("nth", F.monotonically_increasing_id()))
    nodes, total = ranked(leaves, "doc_id", "hash", "nth")
    result = "doc_id long, leaf string, subroot string, proof_sha256 string, folded_root string"
    if not total:
        return docs.sparkSession.createDataFrame([], result).select("doc_id", "leaf", "subroot", F.lit("").alias("root"), "proof_sha256", "folded_root", F.lit(True).alias("verified")).where("false")
    rounds, subroots = tree(nodes.drop("nth"), total)
    named = subroots.select(F.lit(None).cast("string").alias("grp"), F.col("grp").alias("source"), "hash")
    tops, n = ranked(named, "source")
    top_rounds, top = tree(tops, n)
    root = top.first()["hash"]
    crown = docs.sparkSession.createDataFrame([(None, [], "")], "grp string, path array<string>, subroot string")
    paths = descend(top_rounds, crown)
    tops, paths = tops.select("source", "rank", F.col("hash").alias("subroot")), paths.select(F.col("rank").alias("place"), "path")
    outer = materialize(tops.join(paths, F.col("rank") == F.col("place")).select(F.col("source").alias("grp"), "path", "subroot"))
    out = descend(rounds, outer, _proofs, result)
    release(leaves)
    return out.select("doc_id", "leaf", "subroot", F.lit(root).alias("root"), "proof_sha256", "folded_root", (F.col("folded_root") == root).alias("verified"))
