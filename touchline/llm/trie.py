"""Conversation prefix trie by the Euler-tour technique.

Conversations are rebuilt from shared openings, and every distinct sequence of
first turns is a node.  Subtree sums come from a tour of enter and exit arcs:

1. ``_turns`` sorts the turns of all conversations over range partitions and
   takes running fingerprints (two 64-bit polynomials over sha-256 digests of
   role and text).  A conversation may span partitions: each partition's last
   conversation is carried into the next by a table of one row per partition.
2. A rebuilt conversation's fingerprints follow from those of its own and its
   opening's turns by arithmetic, so no turn is copied out; openings are counted
   once for all conversations that share them.
3. ``_arcs`` sorts every node, its children and the conversations that end at
   it side by side over range partitions.  Neighbours in that order are each
   arc's successor: a node enters its first child, a child's exit goes to its
   sibling or back to the parent.  A node with a third of all children spans
   partitions; what crosses a bound is again one row per partition.
4. List ranking: ``_contract`` takes the arcs by range of (smallest member,
   depth), under which each conversation's own path is a run, joins the arcs
   whose successors lie in the same partition to chains, and ``_jump`` ranks
   the chains by pointer jumping.  Sums from an arc to the tour's end, taken at
   a node's enter and exit, differ by the sums of its subtree.

Children stand in order of their smallest member; a node is named by (smallest
member, depth), as a conversation's path has one node a depth.

Defined results: null role or text is empty; a null turn comes first; turns
with equal numbers stand in the order of their digests; rows that repeat are
turns of their own; rows with a null conv_id belong to no conversation; an
empty table has no node, not even the root; other input columns are ignored.
Negative ids take the opening of ``conv_id - conv_id % 100`` with the sign of
SQL's remainder.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import discard, partitions, python_tasks, scratch, store

#: Conversations that share an opening, and turns that an opening has at most, plus one.
FAMILY, OPENINGS = 100, 6
#: Rows of a range partition that one task holds.
TASK_ROWS = 1 << 20
#: Fixed odd multipliers of the two fingerprints, and their inverses mod 2^64.
_BASES = tuple(np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F))
_BACK = tuple(np.uint64(pow(int(x), -1, 1 << 64)) for x in _BASES)
NO_ENDS = hashlib.sha256(b"").hexdigest()


def _power(base: np.uint64, exponent: np.ndarray) -> np.ndarray:
    out, e = np.ones(len(exponent), np.uint64), exponent.astype(np.uint64)
    while e.any():
        out[(e & np.uint64(1)) == 1] *= base
        base = base * base
        e >>= np.uint64(1)
    return out


def _long(column: pa.Array, null: int = 0) -> np.ndarray:
    return column.fill_null(null).to_numpy(zero_copy_only=False).astype(np.int64)


def _batch(schema: dict, columns: dict) -> pa.RecordBatch:
    return pa.record_batch([pa.array(columns[k], t) for k, t in schema.items()], list(schema))


def _ranges(df: DataFrame, rows: int, keys: list[str], then: list[str] | None = None) -> DataFrame:
    """``df`` range-partitioned by ``keys`` and sorted by these and ``then``, about TASK_ROWS rows a partition."""
    n = max(partitions(df.sparkSession), -(-rows // TASK_ROWS))
    return df.repartitionByRange(n, *keys).sortWithinPartitions(*keys, *(then or []))


_TURNS = {"pid": pa.int32(), "head": pa.bool_(), "conv": pa.int64(), "pos": pa.int64(), "chars": pa.int64(),
          **{k: pa.int64() for k in ("p1", "p2", "q1", "q2")}}


def _prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Position and fingerprints (with and without the turn itself) of sorted turns inside a partition."""
    from pyspark import TaskContext

    pid, first, last, count, sums = TaskContext.get().partitionId(), None, None, 0, [np.uint64(0)] * 2
    for b in batches:
        n = b.num_rows
        if not n:
            continue
        conv = _long(b.column(0))
        raw = np.frombuffer(b"".join(b.column(1).to_pylist()), "<u8").reshape(n, 2)
        new = np.ones(n, bool)
        new[1:] = conv[1:] != conv[:-1]
        if conv[0] == last:
            new[0] = False
        else:
            count, sums = 0, [np.uint64(0)] * 2
        first = conv[0] if first is None else first
        start = np.maximum.accumulate(np.where(new, np.arange(n), -1))
        pos = np.arange(n) - start
        pos[start < 0] = np.arange(n)[start < 0] + count
        out = {"pid": np.full(n, pid), "head": conv == first, "conv": conv, "pos": pos, "chars": _long(b.column(2))}
        for k in (0, 1):
            x = raw[:, k] * _power(_BASES[k], pos)
            total = np.cumsum(x, dtype=np.uint64)
            before = np.where(start > 0, total[np.maximum(start - 1, 0)], np.uint64(0))
            p = total - before
            p[start < 0] += sums[k]
            sums[k] = p[-1]
            out[f"p{k + 1}"], out[f"q{k + 1}"] = p.view(np.int64), (p - x).view(np.int64)
        last, count = conv[-1], pos[-1] + 1
        yield _batch(_TURNS, out)


def _turns(conversations: DataFrame) -> DataFrame:
    """(conv, pos, chars, p1, p2, q1, q2) of every turn: its position and the fingerprints up to
    it, with it (p) and without (q)."""
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    digest = F.sha2(F.concat(F.length(text("role")).cast("string"), F.lit(":"), text("role"), text("text")), 256)
    rows = (conversations.filter("conv_id is not null")
            .select(F.col("conv_id").cast("long").alias("conv"), F.unhex(F.substring(digest, 1, 32)).alias("digest"),
                    F.char_length(text("text")).cast("long").alias("chars"), F.col("turn").cast("long").alias("turn")))
    sorted_ = _ranges(rows, conversations.count(), ["conv", "turn", "digest"]).select("conv", "digest", "chars")
    turns = store(sorted_.mapInArrow(_prefixes, ", ".join(f"{k} {t}" for k, t in _sql(_TURNS))), "turns")

    # one row per partition reaches the driver
    ends = turns.groupBy("pid").agg(F.min("conv").alias("first"), F.max(F.struct("conv", "pos", "p1", "p2")).alias("last")).orderBy("pid").collect()
    carry, add = None, {}
    for r in ends:
        at, n, s = r["last"]["conv"], r["last"]["pos"] + 1, [r["last"][f"p{k}"] % (1 << 64) for k in (1, 2)]
        if carry and carry[0] == r["first"]:
            add[r["pid"]] = carry[1:]
            if at == r["first"]:
                s = [(c + pow(int(b), carry[1], 1 << 64) * x) % (1 << 64) for c, b, x in zip(carry[2], _BASES, s)]
                n += carry[1]
        carry = (at, n, s)

    def shift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = {k: b.column(k) for k in _TURNS}
            pid = _long(b.column("pid"))
            got = [add.get(p, (0, [0, 0])) for p in pid]
            off = np.array([g[0] for g in got], np.int64)
            out["pos"] = _long(b.column("pos")) + off
            for k in (0, 1):
                carried = np.array([g[1][k] for g in got], np.uint64)
                for c in "pq":
                    local = _long(b.column(f"{c}{k + 1}")).view(np.uint64)
                    out[f"{c}{k + 1}"] = (carried + _power(_BASES[k], off) * local).view(np.int64)
            yield _batch(_TURNS, out)

    crossing = F.col("head") & F.col("pid").isin(list(add))
    if add:
        turns = turns.filter(~crossing).unionByName(turns.filter(crossing).mapInArrow(shift, turns.schema))
    return turns.drop("pid", "head")


def _sql(schema: dict) -> list[tuple[str, str]]:
    names = {pa.int64(): "long", pa.int32(): "int", pa.bool_(): "boolean", pa.string(): "string"}
    return [(k, names[t]) for k, t in schema.items()]


def _opening(conv: Column) -> Column:
    return conv - conv % FAMILY


def _rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(stored info of every conversation: conv, h, own fingerprint at h (a), opening's length and
    fingerprint (len, c); stored own turns of rebuilt conversations: depth, fingerprint f, that of the parent g, chars)."""
    h = F.crc32(F.col("conv").cast("string").cast("binary")) % OPENINGS
    own = turns.withColumn("h", h.cast("long")).groupBy("conv").agg(
        F.count(F.lit(1)).alias("n"), F.min("h").alias("h"),
        *[F.coalesce(F.max(F.when(F.col("pos") + 1 == F.col("h"), F.col(f"p{k}"))), F.lit(0)).alias(f"a{k}") for k in (1, 2)])
    # at most OPENINGS - 1 turns of each opening
    openings = (turns.filter(F.col("pos") < OPENINGS - 1).filter(F.col("conv") % FAMILY == 0).groupBy(F.col("conv").alias("base"))
                .agg(F.sort_array(F.collect_list(F.struct("pos", "p1", "p2"))).alias("first")))
    length = F.least("h", F.coalesce(F.size("first"), F.lit(0)))
    info = (own.withColumn("base", _opening(F.col("conv"))).join(openings, "base", "left")
            .withColumn("len", F.when(F.col("first").isNull(), F.lit(0)).otherwise(length).cast("long"))
            .select("conv", "base", "n", "h", "len", "a1", "a2",
                    *[F.coalesce(F.get("first", (F.col("len") - 1).cast("int"))[f"p{k}"], F.lit(0)).alias(f"c{k}") for k in (1, 2)]))
    info = store(info, "rebuilt")

    schema = {"depth": pa.int64(), **{k: pa.int64() for k in ("f1", "f2", "g1", "g2", "chars", "conv")}, "last": pa.bool_()}

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = {k: _long(b.column(k)) for k in b.schema.names}
            out = {"depth": x["pos"] + 1 - x["h"] + x["len"], "chars": x["chars"], "conv": x["conv"], "last": x["pos"] + 1 == x["n"]}
            for k in (1, 2):
                u = {c: x[f"{c}{k}"].view(np.uint64) for c in "pqac"}
                back = _power(_BACK[k - 1], x["h"] - x["len"])
                for to, of in (("f", "p"), ("g", "q")):
                    out[f"{to}{k}"] = (u["c"] + back * (u[of] - u["a"])).view(np.int64)
            yield _batch(schema, out)

    rest = turns.join(info.filter("n > h"), "conv").filter("pos >= h").drop("base")
    return info, store(rest.mapInArrow(place, ", ".join(f"{k} {t}" for k, t in _sql(schema))), "own-turns")


def _nodes(turns: DataFrame, info: DataFrame, own: DataFrame) -> DataFrame:
    """(depth, f1, f2, g1, g2, chars, n, conv) of every node below and with the root."""
    shared = info.groupBy("base", "h").agg(F.count(F.lit(1)).alias("n"), F.min("conv").alias("least"))
    opened = (turns.filter(F.col("pos") < OPENINGS - 1).filter(F.col("conv") % FAMILY == 0)
              .join(shared.withColumnRenamed("base", "conv"), "conv").filter("pos < h")
              .select((F.col("pos") + 1).alias("depth"), F.col("p1").alias("f1"), F.col("p2").alias("f2"), F.col("q1").alias("g1"),
                      F.col("q2").alias("g2"), "chars", "n", F.col("least").alias("conv")))
    rest = own.select("depth", "f1", "f2", "g1", "g2", "chars", F.lit(1).cast("long").alias("n"), "conv")
    below = rest.unionByName(opened).groupBy("depth", "f1", "f2").agg(
        *[F.min(c).alias(c) for c in ("g1", "g2", "chars")], F.sum("n").alias("n"), F.min("conv").alias("conv"))
    zero = F.lit(0).cast("long")
    root = info.agg(F.count(F.lit(1)).alias("n"), F.min("conv").alias("conv")).filter("n > 0").select(
        *[zero.alias(c) for c in ("depth", "f1", "f2", "g1", "g2", "chars")], "n", "conv")
    return below.unionByName(root)


#: What a row of the tour is: an enter arc, an exit arc, conversations that end at a node, more children of it, a partition's bounds.
ENTER, EXIT, ENDS, MORE, BOUNDS = range(5)
_ARCS = {"kind": pa.int32(), "pid": pa.int32(), "conv": pa.int64(), "depth": pa.int64(), "owner": pa.int64(), "follows": pa.int64(),
         "tail": pa.bool_(), "n": pa.int64(), "saved": pa.int64(), "children": pa.int64(), "seq": pa.int64(), "text": pa.string()}
#: Kinds of rows in the order inside a node's group.
_NODE, _END, _CHILD = range(3)


def _links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arcs of sorted groups.  Each group is a node, the conversations that end at it and its children.
    A row's node is the last node row before it; null where that is in an earlier partition."""
    from pyspark import TaskContext

    pid = TaskContext.get().partitionId()
    owner, held, lead, seen = None, None, (0, None), False

    def rows(**columns) -> pa.RecordBatch:
        n = len(columns["conv"])
        full = {k: columns.get(k, [None] * n) for k in _ARCS}
        return _batch(_ARCS, full | {"pid": [pid] * n})

    for b in batches:
        kind, depth, conv, n, chars = (_long(b.column(c)) for c in ("kind", "depth", "conv", "n", "chars"))
        if not len(kind):
            continue
        seen = True
        at = np.maximum.accumulate(np.where(kind == _NODE, np.arange(len(kind)), -1))
        own = pa.array(conv[np.maximum(at, 0)], pa.int64(), mask=at < 0)
        if owner is not None:
            own = own.fill_null(owner)
        # conversations that end at a node: their numbers joined, by node and batch
        ends = np.flatnonzero(kind == _END)
        if len(ends):
            cuts = np.flatnonzero(np.r_[True, at[ends][1:] != at[ends][:-1]])
            number = conv[ends].astype(str)
            yield rows(kind=[ENDS] * len(cuts), conv=own.take(pa.array(ends[cuts])), owner=own.take(pa.array(ends[cuts])), depth=depth[ends[cuts]],
                       seq=conv[ends[cuts]], text=[",".join(number[a:z]) for a, z in zip(cuts, [*cuts[1:], len(ends)])])
        arcs = np.flatnonzero(kind != _END)
        if not len(arcs):
            continue  # the node stays that of earlier batches
        # children in this batch, counted at their node or, for one of an earlier batch, on a row of their own
        child = kind[arcs] == _CHILD
        nodes = np.flatnonzero(~child)
        ahead = int(nodes[0]) if len(nodes) else len(arcs)
        if ahead:
            yield rows(kind=[MORE], conv=own.slice(int(arcs[0]), 1), owner=own.slice(int(arcs[0]), 1), depth=[int(depth[arcs[0]])], children=[ahead])
        counts = np.zeros(len(arcs), np.int64)
        counts[nodes] = np.diff(np.r_[nodes, len(arcs)]) - 1
        found = {"kind": np.where(child, EXIT, ENTER), "conv": conv[arcs], "depth": depth[arcs] + child, "owner": own.take(pa.array(arcs)),
                 "n": n[arcs], "saved": np.where(child, 0, (n[arcs] - 1) * chars[arcs]), "children": counts}
        if held is not None:
            found = {k: pa.concat_arrays([held[k], pa.array(v, held[k].type)]) for k, v in found.items()}
        else:
            lead = (int(child[0]), int(conv[arcs[0]]))
            found = {k: pa.array(v, _ARCS[k]) for k, v in found.items()}
        size = len(found["kind"])
        kinds, numbers = _long(found["kind"]), _long(found["conv"])
        follows = pa.array(numbers[1:], pa.int64(), mask=kinds[1:] != EXIT)
        held = {k: v.slice(size - 1) for k, v in found.items()}
        if size > 1:
            yield rows(**{k: v.slice(0, size - 1) for k, v in found.items()}, follows=follows, tail=[False] * (size - 1))
        owner = own[len(own) - 1].as_py()
    if held is not None:
        yield rows(**held, tail=[True])
    if seen:
        # the first arc row, which may be a child that follows an earlier partition's last arc, and the last node
        yield rows(kind=[BOUNDS], conv=[lead[1]], owner=[owner], children=[lead[0]])


def _arcs(nodes: DataFrame, info: DataFrame, own: DataFrame) -> DataFrame:
    """The stored arcs with their successors (to, to_depth, to_exit), ends and further children of the nodes."""
    zero = F.lit(0).cast("long")
    sides = nodes.select(F.explode(F.array(
        F.struct(F.col("depth"), F.col("f1"), F.col("f2"), F.lit(_NODE).alias("kind"), F.col("conv"), F.col("n"), F.col("chars")),
        F.struct((F.col("depth") - 1).alias("depth"), F.col("g1").alias("f1"), F.col("g2").alias("f2"), F.lit(_CHILD).alias("kind"), F.col("conv"), zero.alias("n"), zero.alias("chars"))
    )).alias("r")).select("r.*").filter("depth >= 0")
    ends = (own.filter("last").select("depth", "f1", "f2", "conv")
            .unionByName(info.filter("n <= h").select(F.col("len").alias("depth"), F.col("c1").alias("f1"), F.col("c2").alias("f2"), "conv"))
            .select("depth", "f1", "f2", F.lit(_END).alias("kind"), "conv", zero.alias("n"), zero.alias("chars")))
    rows = sides.unionByName(ends)
    size = 2 * own.count() + info.count()
    arcs = store(_ranges(rows, size, ["depth", "f1", "f2", "kind", "conv"]).mapInArrow(_links, ", ".join(f"{k} {t}" for k, t in _sql(_ARCS))), "arcs")

    # one row per partition reaches the driver: the node carried in, and the child that follows the last arc
    bounds = arcs.filter(F.col("kind") == BOUNDS).select("pid", "conv", "owner", "children").orderBy("pid").collect()
    carried, fixes = None, []
    for i, r in enumerate(bounds):
        after = next((x for x in bounds[i + 1:i + 2 + len(bounds)] if x["conv"] is not None), None)
        fixes.append((r["pid"], carried, after["conv"] if after and after["children"] else None))
        carried = r["owner"] if r["owner"] is not None else carried
    fix = arcs.sparkSession.createDataFrame(fixes, "pid int, carried long, after long")
    arcs = arcs.filter(F.col("kind") != BOUNDS).join(F.broadcast(fix), "pid")
    follows = F.when(F.col("tail"), F.col("after")).otherwise(F.col("follows"))
    owner = F.coalesce("owner", "carried")
    level = F.col("depth") - F.when(F.col("kind") == EXIT, 1).otherwise(0)
    arc = F.col("kind").isin(ENTER, EXIT)
    return arcs.select(
        F.coalesce("conv", "carried").alias("conv"), "depth", "kind", "seq", "text", "n", "saved", "children", owner.alias("owner"),
        F.when(arc, F.coalesce(follows, owner)).alias("to"), F.when(arc, level + F.when(follows.isNotNull(), 1).otherwise(0)).alias("to_depth"),
        F.when(arc, follows.isNull()).alias("to_exit"))


_POINT = ("conv", "depth", "exit")
_RANKED = {"chain": pa.bool_(), "conv": pa.int64(), "depth": pa.int64(), "exit": pa.bool_(), "parent": pa.int64(), "n": pa.int64(), "children": pa.int64(),
           "leaves": pa.int64(), "saved": pa.int64(), "ends": pa.string(),
           **{f"{side}_{k}": t for side in ("to", "less") for k, t in zip(_POINT, (pa.int64(), pa.int64(), pa.bool_()))}}


def _contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A range of nodes: arcs joined to chains inside the range, sums from every arc to its
    chain's end, and the hash of the conversations that end at each node, taken as they pass."""
    kept, hashes, at, sha = [], [], None, None
    for b in batches:
        kind = _long(b.column("kind"))
        texts = np.flatnonzero(kind == ENDS)
        if len(texts):
            some = b.take(pa.array(texts))
            for conv, depth, text in zip(*(some.column(c).to_pylist() for c in ("conv", "depth", "text"))):
                if at == (conv, depth):
                    sha.update(b"," + text.encode())
                else:
                    if at:
                        hashes.append((*at, sha.hexdigest()))
                    at, sha = (conv, depth), hashlib.sha256(text.encode())
        kept.append(b.filter(pa.array(kind != ENDS)).drop_columns(["text", "seq"]))
    if at:
        hashes.append((*at, sha.hexdigest()))
    if not kept:
        return
    rows = pa.Table.from_batches(kept).combine_chunks()
    kind = _long(rows["kind"])
    enter, leave, more = (rows.filter(pa.array(kind == k)) for k in (ENTER, EXIT, MORE))
    conv, depth = _long(enter["conv"]), _long(enter["depth"])
    size = len(conv)
    # a conversation's own nodes stand at successive depths
    names, starts, counts = np.unique(conv, return_index=True, return_counts=True)

    def find(c: np.ndarray, d: np.ndarray) -> np.ndarray:
        if not size:
            return np.full(len(c), -1)
        i = np.minimum(np.searchsorted(names, c), len(names) - 1)
        off = d - depth[starts[i]]
        return np.where((names[i] == c) & (off >= 0) & (off < counts[i]), starts[i] + off, -1)

    # arcs: the enter arcs of all nodes, then the exit arcs of all but the root
    mine = find(_long(leave["conv"]), _long(leave["depth"]))
    exits = np.full(size, -1)
    exits[mine] = size + np.arange(len(mine))
    both = pa.concat_tables([enter, leave]).combine_chunks()
    to = [_long(both["to"]), _long(both["to_depth"]), both["to_exit"].to_numpy().astype(bool)]
    over = to[2] & (to[1] == 0)  # the root's exit ends the tour
    inside = find(to[0], to[1])
    after = np.where(over | (inside < 0), -1, np.where(to[2], exits[inside] if size else -1, inside))
    leaf = np.zeros(len(after), np.int64)
    leaf[:size] = to[2][:size] & (to[0][:size] == conv) & (to[1][:size] == depth)
    weight = [leaf, _long(both["saved"])]
    head = np.ones(len(after), bool)
    head[after[after >= 0]] = False
    jump, end = after.copy(), np.arange(len(after))
    while len(live := np.flatnonzero(jump >= 0)):
        target = jump[live]
        for w in weight:
            w[live] += w[target]
        end[live] = end[target]
        jump[live] = jump[target]

    def point(side: str, of: np.ndarray, none: np.ndarray) -> dict:
        return {f"{side}_{k}": pa.array(x[of], mask=none) for k, x in zip(_POINT, to)}

    def rows_of(**columns) -> pa.RecordBatch:
        n = len(columns["conv"])
        return _batch(_RANKED, {k: columns.get(k, [None] * n) for k in _RANKED})

    children = _long(enter["children"])
    np.add.at(children, find(_long(more["conv"]), _long(more["depth"])), _long(more["children"]))
    parent, has = np.zeros(size, np.int64), exits >= 0
    parent[mine] = _long(leave["owner"])
    out = np.where(has, exits, 0)
    same = has & (end[:size] == end[out])
    sums = [w[:size] - np.where(has, w[out], 0) for w in weight]
    text = np.full(size, NO_ENDS, object)
    if hashes:
        cs, ds, digests = zip(*hashes)
        text[find(np.array(cs), np.array(ds))] = digests
    yield rows_of(chain=[False] * size, conv=conv, depth=depth, parent=pa.array(parent, mask=~has), n=enter["n"].combine_chunks(), children=children,
                  leaves=sums[0], saved=sums[1], ends=text, **point("to", end[:size], same | over[end[:size]]),
                  **point("less", end[out], same | ~has | over[end[out]]))
    heads = np.flatnonzero(head)
    both_conv, both_depth = _long(both["conv"]), _long(both["depth"])
    yield rows_of(chain=[True] * len(heads), conv=both_conv[heads], depth=both_depth[heads], exit=heads >= size,
                  leaves=weight[0][heads], saved=weight[1][heads], **point("to", end[heads], over[end[heads]]))


def _jump(chains: DataFrame) -> DataFrame:
    """Sums from every chain's head to the end of the tour, by pointer jumping: rounds grow with the
    logarithm of the number of chains; chains that have reached the end pass unjoined."""
    spark = chains.sparkSession
    ahead = [f"to_{k}" for k in _POINT]
    chains = chains.select(*_POINT, *ahead, "leaves", "saved")
    path = scratch(spark, "chains")
    chains.write.parquet(path)
    while True:
        now = spark.read.schema(chains.schema).parquet(path)
        live = now.filter("to_conv is not null")
        if live.isEmpty():
            return now
        other = now.select(*[F.col(k).alias(f"at_{k}") for k in _POINT], *[F.col(c).alias(f"next_{c}") for c in (*ahead, "leaves", "saved")])
        met = live.join(other, [F.col(f"to_{k}") == F.col(f"at_{k}") for k in _POINT], "left").select(
            *_POINT, *[F.col(f"next_{c}").alias(c) for c in ahead],
            *[(F.col(c) + F.col(f"next_{c}")).alias(c) for c in ("leaves", "saved")])
        after = scratch(spark, "chains")
        met.unionByName(now.filter("to_conv is null")).write.parquet(after)
        discard(spark, path)
        path = after


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256) of every node."""
    python_tasks(conversations.sparkSession)
    turns = _turns(conversations)
    info, own = _rebuilt(turns)
    arcs = _arcs(_nodes(turns, info, own), info, own)
    ranked = store(_ranges(arcs, 2 * own.count() + info.count(), ["conv", "depth"], ["kind", "seq"])
                   .mapInArrow(_contract, ", ".join(f"{k} {t}" for k, t in _sql(_RANKED))), "ranked")
    chains = _jump(ranked.filter("chain"))
    nodes = ranked.filter(~F.col("chain"))
    # most nodes enter and leave in one chain and are done; the others take both chains' sums
    done = nodes.filter("to_conv is null and less_conv is null")
    for side, sign in (("to", 1), ("less", -1)):
        sums = chains.select(*[F.col(k).alias(f"at_{k}") for k in _POINT], *[(F.col(c) * sign).alias(f"{side}_{c}") for c in ("leaves", "saved")])
        part = nodes.filter("to_conv is not null or less_conv is not null") if side == "to" else crossing
        crossing = part.join(sums, [F.col(f"{side}_{k}") == F.col(f"at_{k}") for k in _POINT], "left").drop(*[f"at_{k}" for k in _POINT])
    for c in ("leaves", "saved"):
        crossing = crossing.withColumn(c, F.col(c) + F.coalesce(f"to_{c}", F.lit(0)) + F.coalesce(f"less_{c}", F.lit(0)))
    return done.unionByName(crossing.select(*done.columns)).select(
        F.col("conv").alias("conv_id"), "depth", F.col("parent").alias("parent_conv_id"), F.col("n").alias("n_convs"),
        F.col("children").alias("n_children"), F.col("leaves").alias("n_leaves"), F.col("saved").alias("saved_tokens"), F.col("ends").alias("ends_sha256"))
