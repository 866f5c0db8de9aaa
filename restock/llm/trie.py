"""Prefix trie of conversations by burst tries.

A conversation is its turns in order (null turn numbers first; ties by the turns'
ids), each turn an id of 22 characters (MD5 of role and text) and a number of
words. Sequences are cut into bands of ``band`` turns, so that a conversation of
any length goes as pieces of bounded size; the pieces of a band that follow the
same turns are the suffixes under one trie head. Equal pieces are counted once,
with their number of conversations.

*Bursting.* A shard's container holds the suffixes under a head: at first, a
band's head. Containers of more than ``limit`` suffixes burst: past the turns that
all of the container share (the common prefix of its smallest and its largest
suffix), each goes to the container of its next turn id, until all fit or have one
suffix. The remaining containers are dealt to tasks, sorted and swept into nodes:
what a suffix shares with the one before it are nodes met already, the rest are
new. A node is named by the first suffix, in sorted order, that reaches it, and its
depth; the containers of a burst head know that name too, as the smallest suffix
is the first. The sweep streams, holding two suffixes.

Each suffix adds to the nodes on its path, and Spark sums up by node: members,
smallest conversation, children (new nodes one deeper), leaves, and the words of
its turns from there on, once for each member less once for each new node, so that
a node's sum is that of (members - 1) * words over its subtree. Conversations of
more than one band add what their later pieces give to the nodes of the earlier.

Ends are the ids of the conversations that end at a node, hashed in a stream of
sorted runs of at most 2 ** ``RUN_BITS`` ids. Turns are numbered run by run of the
sorted table, each run a partition, and a run's numbers go on from the conversation's
turns in the runs before it; so a conversation that has a third of all turns is spread
like any other rows. Only ids and word counts are shuffled, never texts.

Null role or text is empty. Rows with a null conv_id belong to no conversation.
Rows repeated exactly are turns of their own. Other columns play no part. An empty
table has no nodes, not even a root.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from restock.llm.common import drop_staged, stage, table

WIDTH = 22  # characters of a turn's id
BAND = 1024
LIMIT = 4096
RUN_BITS = 12
REPEATS = 1024  # equal turns written out at a time
EVERY = 20


ORDER = ("turn", "turn_id")  # ascending, null first


def sorted_runs(df: DataFrame) -> DataFrame:
    """``(conv_id, turn, turn_id, words, n, run)``: the different turns of the rows
    (conv_id, turn, role, text) with their numbers of rows, cut into runs of the
    sorted table that each fit a partition, whatever conversation they are of."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = df.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        F.substring(F.base64(F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text)))), 1, WIDTH).alias("turn_id"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"))
    same = stage(rows.groupBy("conv_id", "turn", "turn_id", "words").agg(F.count("*").alias("n")), "trie-rows")
    runs = stage(same.repartitionByRange("conv_id", *ORDER).withColumn("run", F.spark_partition_id()), "trie-runs")
    drop_staged(same)
    return runs


def turns(df: DataFrame) -> DataFrame:
    """``(conv_id, pos, turn_id, words)`` of the rows (conv_id, turn, role,
    text): positions from 1 in the order of the turns."""
    runs = sorted_runs(df)
    before = W.partitionBy("conv_id").orderBy("run").rowsBetween(W.unboundedPreceding, -1)
    sizes = runs.groupBy("conv_id", "run").agg(F.sum("n").alias("size"))  # a conversation has a row for each of its runs
    starts = sizes.select("conv_id", "run", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"))
    within = W.partitionBy("conv_id", "run").orderBy(*ORDER).rowsBetween(W.unboundedPreceding, 0)
    placed = runs.withColumn("upto", F.sum("n").over(within)).join(starts, ["conv_id", "run"])
    last = F.col("start") + F.col("upto")
    # repeated rows, some at a time, so that no array grows with their number
    some = placed.select("conv_id", "turn_id", "words", last.alias("last"),
                         F.explode(F.sequence(last - F.col("n") + 1, last, F.lit(REPEATS).cast("long"))).alias("at"))
    return some.select("conv_id", F.explode(F.sequence("at", F.least(F.col("at") + REPEATS - 1, F.col("last")))).alias("pos"), "turn_id", "words")


def rebuilt(t: DataFrame, every: int = EVERY) -> DataFrame:
    """``t``, with each conversation c rebuilt: the first h turns of conversation
    c - c % ``every``, then its own after the first h, for h = CRC-32 of c % 4.
    Turnless conversations have one row, at position 0."""
    t = stage(t, "trie-turns")
    convs = t.groupBy("conv_id").agg(F.count("*").alias("own"))
    convs = convs.select("conv_id", (F.col("conv_id") - F.col("conv_id") % every).alias("base"),
                         (F.crc32(F.col("conv_id").cast("string").cast("binary")) % 4).alias("h"))
    first = t.where((F.col("pos") <= 3) & (F.col("conv_id") % every == 0))
    begun = first.groupBy(F.col("conv_id").alias("base")).agg(F.count("*").alias("there"))
    convs = stage(convs.join(begun, "base", "left").select("conv_id", "base", "h", F.least("h", F.coalesce("there", F.lit(0))).alias("given")),
                  "trie-conversations")
    before = (convs.join(first.withColumnRenamed("conv_id", "base"), "base").where("pos <= h")
              .select("conv_id", "pos", "turn_id", "words"))
    after = t.join(convs, "conv_id").where("pos > h").select("conv_id", (F.col("pos") - F.col("h") + F.col("given")).alias("pos"), "turn_id", "words")
    return before.unionByName(after).unionByName(_starts(convs))


def _starts(convs: DataFrame) -> DataFrame:
    return convs.select("conv_id", F.lit(0).cast("long").alias("pos"), F.lit("").alias("turn_id"), F.lit(0).cast("long").alias("words"))


def _hashes(band: Column, ids: Column) -> list[Column]:
    """Two 64-bit hashes of a piece, 0 for the empty one."""
    empty = ids == ""
    return [F.when(empty, F.lit(0).cast("long")).otherwise(x) for x in (F.xxhash64(band, ids), F.xxhash64(F.lit("2"), ids, band))]


def pieces(t: DataFrame, band: int = BAND) -> DataFrame:
    """A row for each conversation and band: ``conv_id, band, more`` (it goes on),
    ``h1, h2`` (head: hash of what comes before), ``k1, k2`` (hash with the piece),
    ``ids`` (joined turn ids) and ``words``. Rows at position 0 only start a
    conversation."""
    at = F.greatest(F.col("pos") - 1, F.lit(0))
    own = F.array_sort(F.collect_list(F.when(F.col("pos") > 0, F.struct("pos", "turn_id", "words"))))
    p = t.groupBy("conv_id", F.floor(at / band).cast("int").alias("band")).agg(own.alias("own"))
    p = p.select("conv_id", "band", F.array_join("own.turn_id", "").alias("ids"), F.col("own.words").alias("words"))
    x, y = _hashes(F.col("band"), F.col("ids"))
    p = stage(p.select("*", x.alias("x"), y.alias("y")), "trie-bands")
    # by conversation, only the hashes of its pieces meet
    order = W.partitionBy("conv_id").orderBy("band")
    so_far = order.rowsBetween(W.unboundedPreceding, 0)
    names = p.select("conv_id", "band", F.bit_xor("x").over(so_far).alias("k1"), F.bit_xor("y").over(so_far).alias("k2"),
                     F.lead("band").over(order).isNotNull().alias("more"))
    named = p.join(names, ["conv_id", "band"])
    out = stage(named.select("conv_id", "band", "more", F.col("k1").bitwiseXOR(F.col("x")).alias("h1"), F.col("k2").bitwiseXOR(F.col("y")).alias("h2"),
                             "k1", "k2", "ids", "words"), "trie-pieces")
    drop_staged(p)
    return out


def suffixes(p: DataFrame) -> DataFrame:
    """The different pieces: number of conversations, the smallest, and whether
    any goes on in the next band."""
    return p.groupBy("band", "h1", "h2", "k1", "k2", "ids").agg(
        F.count("*").alias("n"), F.min("conv_id").alias("least"), F.max("more").alias("more"), F.first("words").alias("words"))


def burst(s: DataFrame, limit: int = LIMIT) -> DataFrame:
    """``s`` with ``c1, c2``, its container, ``heads``: the nodes of burst heads on
    its path, as (last depth, name) in order of depth, and ``inner``: whether a
    burst has shown longer suffixes. Names are the hashes k1, k2."""
    name = F.struct("k1", "k2")
    s = s.select("*", F.xxhash64("band", "h1", "h2").alias("c1"), F.xxhash64(F.lit("2"), "h2", "h1", "band").alias("c2"),
                 F.array().cast("array<struct<upto:int,k1:bigint,k2:bigint>>").alias("heads"), F.lit(False).alias("inner"))
    rows, done = stage(s, "trie-containers"), None
    while True:
        ends = rows.groupBy("c1", "c2").agg(F.count("*").alias("rows"), F.min(F.struct("ids", name.alias("name"))).alias("low"),
                                            F.max("ids").alias("high"))
        ends = ends.where(F.col("rows") > limit).select("c1", "c2", "low.name", _shared(F.col("low.ids"), F.col("high")).alias("upto"))
        marked = stage(rows.join(ends, ["c1", "c2"], "left").withColumn("hot", F.col("upto").isNotNull()), "trie-burst", by="hot")
        drop_staged(rows)
        cold = marked.where("not hot").drop("upto", "name", "hot")
        done = cold if done is None else done.unionByName(cold)
        hot = marked.where("hot")
        if hot.isEmpty():
            return done
        following = F.substring("ids", F.col("upto") * WIDTH + 1, F.lit(WIDTH))
        head = F.struct("upto", F.col("name.k1").alias("k1"), F.col("name.k2").alias("k2"))
        rows = stage(hot.select(*[c for c in s.columns if c not in ("c1", "c2", "heads", "inner")],
                                F.xxhash64("c1", "c2", following).alias("c1"), F.xxhash64(F.lit("2"), "c2", following, "c1").alias("c2"),
                                F.concat("heads", F.array(head)).alias("heads"),
                                (F.col("inner") | (F.length("ids") == F.col("upto") * WIDTH)).alias("inner")), "trie-containers")


def _shared(low: Column, high: Column) -> Column:
    """Number of turns that the smallest and the largest suffix share, so all do."""
    least = F.floor(F.least(F.length(low), F.length(high)) / WIDTH).cast("int")
    at = F.filter(F.sequence(F.lit(0), least), lambda i: F.substring(low, i * WIDTH + 1, F.lit(WIDTH)) != F.substring(high, i * WIDTH + 1, F.lit(WIDTH)))
    return F.array_min(at)  # they differ, so at the shorter's end at the latest


SWEPT = ("k1 long, k2 long, depth long, n long, least long, children long, leaves long, saved long, "
         "up1 long, up2 long, own1 long, own2 long, more boolean")


def _sweep(band: int):
    """Sorted suffixes -> what each adds to the nodes on its path. ``up`` names
    the parent of a new node, ``own`` the suffix itself; the row at depth -1
    sums the suffix up: (least conversation, words of its new nodes, leaf)."""

    def path_of(row, before):
        """Names of the nodes at depths 0.. of the piece, and how many were met already."""
        ids, count = row["ids"], len(row["words"])
        own = (row["k1"], row["k2"])
        if before is not None and before["box"] == row["box"]:
            low, names = 0, before["names"]
            top = min(len(names) - 1, count)
            while low < top and before["ids"][low * WIDTH : (low + 1) * WIDTH] == ids[low * WIDTH : (low + 1) * WIDTH]:
                low += 1
            return names[: low + 1] + [own] * (count - low), low
        names = [(row["h1"], row["h2"])]
        for head in row["heads"]:
            name = (head["k1"], head["k2"])
            names += [name] * (min(head["upto"], count) + 1 - len(names))
        while len(names) <= count:
            names.append(own)
        met = next((d for d in range(1, count + 1) if names[d] == own), count + 1) - 1
        return names, met

    def added(row, extended: bool):
        names, met, n = row["names"], row["met"], row["n"]
        count, at = len(row["words"]), row["band"] * band
        own = (row["k1"], row["k2"])
        leaf = int(not (extended or row["inner"] or row["more"]))
        saved = new = 0
        out = []
        for d in range(count, -1, -1):
            if d:
                saved += n * row["words"][d - 1]
                if d > met:
                    saved -= row["words"][d - 1]
                    new += row["words"][d - 1]
            child = int(met <= d < count)  # the node one deeper is new
            fresh = d > met
            counted = d > 0 or row["band"] == 0  # a later band's head is counted in the band before
            if counted or child:
                out.append((*names[d], at + d, n if counted else 0, row["least"] if counted else None, child,
                            leaf if counted else 0, saved if counted else 0, *(names[d - 1] if fresh else (None, None)), *own, row["more"]))
        out.append((*own, -1, None, row["least"], None, leaf, new, None, None, None, None, row["more"]))
        return out

    names = [f.split(" ")[0] for f in SWEPT.split(", ")]

    def batch_of(out):
        cols = list(zip(*out))
        return pa.RecordBatch.from_arrays([pa.array(c, pa.bool_() if n == "more" else pa.int64()) for n, c in zip(names, cols)], names)

    def run(batches):
        out: list[tuple] = []
        before = None
        for batch in batches:
            for row in (r for i in range(0, batch.num_rows, 64) for r in batch.slice(i, 64).to_pylist()):
                row["box"] = (row["c1"], row["c2"])
                row["names"], row["met"] = path_of(row, before)
                if before is not None:
                    same = before["box"] == row["box"]
                    out += added(before, same and len(row["ids"]) > len(before["ids"]) and row["ids"].startswith(before["ids"]))
                before = row
                if len(out) > 50_000:
                    yield batch_of(out)
                    out = []
        if before is not None:
            out += added(before, False)
        if out:
            yield batch_of(out)

    return run


def _ends(p: DataFrame) -> DataFrame:
    """``(k1, k2, sha)``: hash of the ids of the conversations that end with a piece."""
    last = p.where("not more").select("k1", "k2", "conv_id", F.shiftright("conv_id", RUN_BITS).alias("run"))
    runs = last.groupBy("k1", "k2", "run").agg(F.array_join(F.sort_array(F.collect_list("conv_id")).cast("array<string>"), ",").alias("ids"))

    def run(batches):
        name = state = None
        out: list[tuple] = []
        for batch in batches:
            for a, b, ids in zip(*(batch.column(c).to_pylist() for c in ("k1", "k2", "ids"))):
                if (a, b) == name:
                    state.update(b",")
                else:
                    if name:
                        out.append((*name, state.hexdigest()))
                    name, state = (a, b), hashlib.sha256()
                state.update(ids.encode())
            if len(out) > 10_000:
                yield _shas(out)
                out = []
        if name:
            yield _shas([*out, (*name, state.hexdigest())])

    return runs.repartition("k1", "k2").sortWithinPartitions("k1", "k2", "run").select("k1", "k2", "ids").mapInArrow(run, "k1 long, k2 long, sha string")


def _shas(out):
    cols = list(zip(*out))
    return pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.string())], ["k1", "k2", "sha"])


def _later(p: DataFrame, swept: DataFrame) -> DataFrame:
    """What the later pieces of conversations of several bands add to the nodes
    of the earlier: rows (k1, k2, depth, leaves, saved)."""
    long = p.where("more or band > 0").select("conv_id", "band", "k1", "k2", F.aggregate("words", F.lit(0).cast("long"), lambda a, b: a + b).alias("words"))
    part = swept.where("depth = -1").select("k1", "k2", F.col("least").alias("rep"), F.col("leaves").alias("leaf"), F.col("saved").alias("new"))
    own = F.col("conv_id") == F.col("rep")
    each = long.join(part, ["k1", "k2"]).select("conv_id", "band", "k1", "k2", (F.col("words") - F.when(own, F.col("new")).otherwise(0)).alias("saved"),
                                                F.when(own, F.col("leaf")).otherwise(0).alias("leaves"))
    after = W.partitionBy("conv_id").orderBy(F.col("band").desc()).rowsBetween(W.unboundedPreceding, -1)
    given = each.select("k1", "k2", F.sum("saved").over(after).alias("saved"), F.sum("leaves").over(after).alias("leaves")).where("saved is not null")
    given = given.groupBy(F.col("k1").alias("own1"), F.col("k2").alias("own2")).agg(F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves"))
    paths = swept.where("more and depth >= 0 and n > 0").select("k1", "k2", "depth", "own1", "own2")
    return paths.join(given, ["own1", "own2"]).select("k1", "k2", "depth", "leaves", "saved")


def nodes(t: DataFrame, band: int = BAND, limit: int = LIMIT) -> DataFrame:
    """The trie over turns ``(conv_id, pos, turn_id, words)``, see :func:`query`."""
    p = pieces(t, band)
    boxes = burst(suffixes(p), limit)
    spread = boxes.repartition("c1", "c2").sortWithinPartitions("c1", "c2", "ids")
    swept = stage(spread.mapInArrow(_sweep(band), SWEPT), "trie-swept")
    zero = F.lit(0).cast("long")
    adds = swept.where("depth >= 0").select("k1", "k2", "depth", "n", "least", "children", "leaves", "saved", "up1", "up2")
    later = _later(p, swept).select("k1", "k2", "depth", zero.alias("n"), F.lit(None).cast("long").alias("least"), zero.alias("children"), "leaves", "saved",
                                    F.lit(None).cast("long").alias("up1"), F.lit(None).cast("long").alias("up2"))
    summed = adds.unionByName(later).groupBy("k1", "k2", "depth").agg(
        F.min("least").alias("conv_id"), F.sum("n").alias("n_convs"), F.sum("children").alias("n_children"), F.sum("leaves").alias("n_leaves"),
        F.sum("saved").alias("saved_tokens"), F.max("up1").alias("up1"), F.max("up2").alias("up2"))
    node = stage(summed, "trie-nodes")
    parent = node.select(F.col("k1").alias("up1"), F.col("k2").alias("up2"), (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("parent_conv_id"))
    # a piece's node is its own at its last turn
    size = p.where("not more").select("k1", "k2", (F.col("band") * band + F.size("words")).cast("long").alias("depth")).distinct()
    shas = _ends(p).join(size, ["k1", "k2"])
    none = hashlib.sha256(b"").hexdigest()
    return (node.join(parent, ["up1", "up2", "depth"], "left").join(shas, ["k1", "k2", "depth"], "left")
            .select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", F.coalesce("sha", F.lit(none)).alias("ends_sha256")))


def query(spark, sf_dir: str) -> DataFrame:
    """The nodes of the trie of all rebuilt conversations: ``conv_id`` (smallest
    member), ``depth``, ``parent_conv_id``, ``n_convs``, ``n_children``,
    ``n_leaves``, ``saved_tokens``, ``ends_sha256``."""
    return nodes(rebuilt(turns(table(spark, sf_dir, "conversations"))))


# CRC-32 byte by byte; the table of 256 steps is made by its rule
ORACLE = """
with recursive bits as (
  select i as b, i::bigint as c, 0 as k from range(256) t(i)
  union all
  select b, case when c % 2 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, k + 1 from bits where k < 8),
steps as (select list(c order by b) as t from bits where k = 8),
turns as (
  select conv_id, row_number() over (partition by conv_id order by turn nulls first, md5(length(r) || ':' || r || x)) as pos,
         md5(length(r) || ':' || r || x) as id, len(regexp_extract_all(x, '[^\\x20\\x09-\\x0D]+')) as words
  from (select conv_id, turn, coalesce(role, '') as r, coalesce(text, '') as x from conversations where conv_id is not null)),
convs as (
  select conv_id, conv_id - conv_id % 20 as base, xor(list_reduce(list_prepend(4294967295::bigint,
      list_transform(string_split(conv_id::varchar, ''), lambda d: ord(d)::bigint)),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295::bigint) % 4 as h
  from (select distinct conv_id from turns), steps),
joined as (
  select convs.conv_id, 0 as part, pos, id, words from convs join turns on turns.conv_id = base and pos <= h
  union all select conv_id, 1, pos, id, words from convs join turns using (conv_id) where pos > h),
placed as (select conv_id, row_number() over (partition by conv_id order by part, pos) as depth, id, words from joined),
members as (
  select conv_id, 0 as depth, '' as path, 0 as words from convs
  union all
  select conv_id, depth, md5(string_agg(id, '') over (partition by conv_id order by depth)), words from placed),
linked as (select *, lag(path) over w as up, lead(path) over w is null as last from members window w as (partition by conv_id order by depth)),
nodes as (
  select path, depth, min(conv_id) as conv_id, count(*) as n_convs, min(words) as words, min(up) as up,
         sha2.f as ends_sha256
  from linked join (select path, sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (last), '')) as f from linked group by path) sha2
  using (path) group by path, depth, sha2.f),
children as (select up as path, count(*) as n from nodes where up is not null group by up),
leaf as (select path, coalesce(n, 0) as n_children from nodes left join children using (path)),
below as (
  select members.path, sum((nodes.n_convs - 1) * nodes.words) as saved, count(*) filter (n_children = 0) as leaves
  from nodes join leaf using (path) join members on members.conv_id = nodes.conv_id and members.depth <= nodes.depth group by members.path)
select a.conv_id, a.depth::bigint as depth, b.conv_id as parent_conv_id, a.n_convs, n_children, leaves as n_leaves, saved::bigint as saved_tokens, a.ends_sha256
from nodes a left join nodes b on a.up = b.path join leaf on a.path = leaf.path join below on a.path = below.path
"""
