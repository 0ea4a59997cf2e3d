"""N-gram Jaccard self-join with PartEnum signatures.

A document is the set of its hashed word shingles. Sets are put in bands of similar size; two sets that reach the threshold are
in one band or in neighbouring ones, and a set close to the lower bound of its band signs for the band below, too. For a band,
the feature domain is cut into ``n`` parts of three sub-parts each, ``n`` such that the ``k`` features in which two similar sets
can differ leave at least one part with at most one changed sub-part. The signatures of a set are, for every part, its
features in each two of the three sub-parts: similar sets share one of them, whatever else they hold.

Signatures meet in buckets by a packed exchange (see ``exchange``) and come out as groups: sets that share a signature. Groups with the
same members are one. No group is turned into all its pairs: every set is first held against one pivot of its groups, exact
Jaccard decides, linked sets become one component, and only groups that still join several components go on. What is left
after a few rounds is compared across components only, where two sets share as many signatures as similar sets of their sizes
must. So no link is lost, and copies cost one comparison each.

Large groups. Similar sets share a known least number of signatures, not only one. So a set leaves its largest groups, as long
as they hold fewer of its signatures than that number: the smallest group that two similar sets share is never left by either.

Exact Jaccard needs both texts. Before they are fetched, bitmaps decide most pairs: bit ``b`` of a set tells whether an odd number of
its features have the hash ``b``, so bitmaps differ in at most as many bits as the sets differ in features, and a pair whose bitmaps
differ in more bits than similar sets of these sizes may is not similar.
"""

from __future__ import annotations

from bisect import bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyledger.llm import exchange
from skyledger.llm.common import block_count, documents, public_id, stored
from skyledger.llm.exchange import narrow, planes, whole
from skyledger.llm.rolling import Words, mixed, word_pieces

U = np.uint64
_FOLD = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
SMALL, SLACK = 4, 1.25  # groups of no more than SMALL members are not worth leaving
BITS = 1024
SENT = ["signatures", "owners", "nodes", "tags", "sizes", "spare"]
LEFT, RIGHT = [0, 0, 1], [1, 2, 2]  # each two of three sub-parts


def shingles(text: str, length: int) -> np.ndarray:
    """Sorted distinct hashes of all runs of ``length`` words; of the whole text if it has fewer."""
    words = text.encode().translate(_FOLD).split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    length = min(length, len(words))
    return np.unique(np.concatenate([Words(part).runs(length) for _, part in word_pieces(words, length - 1)]))


def node(features: np.ndarray) -> int:
    """One name for equal sets."""
    return int(mixed(np.array([np.add.reduce(mixed(features + U(1))) + U(len(features))], dtype=np.uint64)).view(np.int64)[0])


def bitmap(features: np.ndarray) -> np.ndarray:
    """For each of ``BITS`` hashes whether an odd number of features have it, as 64-bit numbers."""
    odd = np.bincount((features & U(BITS - 1)).astype(np.int64), minlength=BITS).astype(np.uint8) & 1
    return np.packbits(odd).view("<i8")


def bounds() -> list[int]:
    """Lower bounds of all size bands: about one and a half times the one before."""
    out = [1]
    while out[-1] < 1 << 40:
        out.append(max(out[-1] + 1, out[-1] * 3 // 2))
    return out


BANDS = bounds()


def signatures(features: np.ndarray, percent: int):
    """``(tag, signatures, spare)`` for every band a set signs for.

    ``spare`` is how many of its parts any similar set shares at least, counting only parts in which every signature has
    features. Where that is none, signatures without features are used as well, so that nothing is missed.
    """
    size, rest = len(features), 100 - percent
    own = bisect_right(BANDS, size) - 1
    values = mixed(features ^ U(0x5851F42D4C957F2D))
    for tag in (own - 1, own):
        # Similar sizes are at least `percent` % of each other.
        if tag < 0 or tag < own and size * percent >= 100 * BANDS[own]:
            continue
        highest = BANDS[tag + 1] - 1
        differ = lambda n: n * rest // percent  # noqa: E731 features in which a set of n and any similar, larger one differ at most
        if differ(min(size, highest)) == 0:
            continue  # only equal sets are similar
        parts = int(SLACK * (differ(highest) // 2 + 1)) + 1
        sub = ((features >> U(32)) * U(3 * parts)) >> U(32)
        cuts = np.searchsorted(sub, np.arange(3 * parts + 1, dtype=np.uint64))
        sums = np.concatenate((np.zeros(1, dtype=np.uint64), np.cumsum(values)))
        sums = (sums[cuts[1:]] - sums[cuts[:-1]]).reshape(parts, 3)
        filled = (np.diff(cuts) > 0).reshape(parts, 3)
        number = np.arange(3 * parts, dtype=np.uint64)
        spare = int((filled.sum(axis=1) >= 2).sum()) - differ(min(size, highest)) // 2
        sign = mixed(sums[:, LEFT] * U(3) + sums[:, RIGHT] * U(0x9FB21C651E98DF25) + number.reshape(parts, 3) * U(0xD6E8FEB86659FD93) + U(tag << 48))
        yield tag, sign.ravel() if spare < 1 else sign[filled[:, LEFT] | filled[:, RIGHT]], max(0, spare)


def set_keys(length: int):
    """Per row: the size of its set, the set's name and bitmap."""
    def run(batches):
        for batch in batches:
            sets = [shingles(text.as_py(), length) for text in batch.column(1)]
            made = [pa.array([len(s) for s in sets], pa.int64()), pa.array([node(s) for s in sets], pa.int64())]
            bits = pa.array([bitmap(s) for s in sets], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([batch.column(0), *made, batch.column(2), bits], ["doc_id", "n_shingles", "node", "text_key", "bits"])
    return run


def sign_letters(buckets: int, length: int, percent: int, some: int = 2048):
    """Signatures of the distinct sets of every few documents, packed by bucket."""
    def run(batches):
        for batch in batches:
            texts = batch.column(0)
            for at in range(0, len(texts), some):
                seen, signs, owners, table = set(), [], [], []
                for text in texts.slice(at, some):
                    features = shingles(text.as_py(), length)
                    name = node(features)
                    if len(features) and name not in seen:
                        seen.add(name)
                        for tag, sign, spare in signatures(features, percent):
                            signs.append(sign)
                            owners.append(np.full(len(sign), len(table)))
                            table.append((name, tag, len(features), spare))
                if not table:
                    continue
                sign, owner = np.concatenate(signs), np.concatenate(owners)
                nodes, tags, sizes, spare = (np.array(x, dtype=np.int64) for x in zip(*table, strict=True))
                sent = []
                for to, part in exchange.parcels(sign % U(buckets), sign=sign, owner=owner):
                    used, short = np.unique(part["owner"], return_inverse=True)
                    sent.append((to, 0, {"signatures": narrow(part["sign"] >> U(24), 5), "owners": planes(short.astype("<u4")), "nodes": nodes[used].tobytes(),
                                         "tags": planes(tags[used]), "sizes": planes(sizes[used]), "spare": planes(spare[used])}))
                yield from exchange.letters(sent, SENT).to_batches()
    return run


GROUP = "gid long, node long, tag int, size long, spare long, members long, n long"


def groups(key, table):
    """Per bucket: sets that share a signature, one row per member; groups with the same members appear once with their number."""
    schema = pa.schema([("gid", pa.int64()), ("node", pa.int64()), ("tag", pa.int32()), ("size", pa.int64()), ("spare", pa.int64()),
                        ("members", pa.int64()), ("n", pa.int64())])
    got = {name: [x.as_py() for x in table.column(name)] for name in SENT}
    sign = np.concatenate([whole(x, 5) for x in got["signatures"]])
    nodes = np.concatenate([np.frombuffer(x, dtype="<i8") for x in got["nodes"]])
    tags, sizes, spare = (np.concatenate([whole(x, 8) for x in got[name]]).astype(np.int64) for name in ("tags", "sizes", "spare"))
    first = np.cumsum([0] + [len(x) // 8 for x in got["nodes"]])
    owner = np.concatenate([whole(x, 4).astype(np.int64) + first[n] for n, x in enumerate(got["owners"])])
    _, name = np.unique(np.stack((nodes, tags)), axis=1, return_inverse=True)  # equal sets of different letters
    keep = np.empty(int(name.max()) + 1, dtype=np.int64)
    keep[name] = np.arange(len(name))
    owner = name[owner]
    order = np.lexsort((owner, sign))
    sign, owner = sign[order], owner[order]
    fresh = np.concatenate(([True], (sign[1:] != sign[:-1]) | (owner[1:] != owner[:-1])))
    sign, owner = sign[fresh], owner[fresh]
    start = np.concatenate(([0], np.flatnonzero(np.diff(sign)) + 1))
    count = np.diff(np.append(start, len(sign)))
    start, count = start[count > 1], count[count > 1]
    if not len(start):
        return pa.table([[]] * 7, schema=schema)
    inside = np.repeat(start - np.concatenate(([0], np.cumsum(count)[:-1])), count) + np.arange(count.sum())
    member = owner[inside]
    at = np.concatenate(([0], np.cumsum(count)[:-1]))
    gid = mixed(np.add.reduceat(mixed(nodes[keep[member]].view(np.uint64) + tags[keep[member]].astype(np.uint64)), at) + count.astype(np.uint64))
    _, head, n = np.unique(gid, return_index=True, return_counts=True)
    times = count[head]
    rows = np.repeat(at[head] - np.concatenate(([0], np.cumsum(times)[:-1])), times) + np.arange(times.sum())
    who = keep[member[rows]]
    return pa.table([np.repeat(gid[head].view(np.int64), times), nodes[who], tags[who].astype(np.int32), sizes[who], spare[who],
                     np.repeat(times, times), np.repeat(n, times)], schema=schema)


def smaller(found: DataFrame) -> DataFrame:
    """The groups of every set without the largest ones that it can leave; ``left`` is how many signatures it left.

    Similar sets share at least ``spare`` signatures. Groups are ordered alike for all sets, and a set leaves fewer than ``spare``
    signatures, from the top of that order; then two similar sets stay in the last group that they share, and share
    at least ``spare - left`` signatures in what they keep, each taken as the larger of the two sets.
    """
    order = Window.partitionBy("node", "tag").orderBy(F.desc("members"), "gid")
    down = found.withColumn("down", F.sum("n").over(order))
    leaves = (F.col("down") < F.col("spare")) & (F.col("members") > SMALL)
    total = F.coalesce(F.sum(F.when(leaves, F.col("n"))).over(Window.partitionBy("node", "tag")), F.lit(0))
    return down.withColumn("left", total).where(~leaves).select("gid", "node", "tag", "size", "n", "spare", "left")


def near(percent: int, a: str = "_a", b: str = "_b"):
    """Whether the bitmaps ``bits<a>`` and ``bits<b>`` of sets of sizes ``size<a>`` and ``size<b>`` allow them to be similar."""
    differ = sum((F.bit_count(F.col(f"bits{a}")[n].bitwiseXOR(F.col(f"bits{b}")[n])) for n in range(1, BITS // 64)),
                 F.bit_count(F.col(f"bits{a}")[0].bitwiseXOR(F.col(f"bits{b}")[0])))
    return differ * (100 + percent) <= (F.col(f"size{a}") + F.col(f"size{b}")) * (100 - percent)


def possible(pairs: DataFrame, maps: DataFrame, percent: int) -> DataFrame:
    """The pairs that their bitmaps do not rule out."""
    a, b = (maps.select(F.col("node").alias(n), F.col("size").alias(f"size_{n}"), F.col("bits").alias(f"bits_{n}")) for n in ("a", "b"))
    return pairs.join(b, "b").join(a, "a").where(near(percent)).select("a", "b")


def similar(length: int, percent: int):
    """Keeps the pairs whose sets reach the threshold."""
    def run(batches):
        last, features = None, None
        for batch in batches:
            linked = []
            for a, b, left, right in zip(*(batch.column(n) for n in range(4)), strict=True):
                if last != a.as_py():
                    last, features = a.as_py(), shingles(left.as_py(), length)
                other = shingles(right.as_py(), length)
                both = len(np.intersect1d(features, other, assume_unique=True))
                linked.append(100 * both >= percent * (len(features) + len(other) - both))
            yield batch.select(["a", "b"]).filter(pa.array(linked, pa.bool_()))
    return run


def components(links: DataFrame) -> DataFrame:
    """``(node, component)`` of all linked nodes: the least node that links reach, by alternating star contraction.

    Each round hangs neighbours on the least node they see: first larger ones, then smaller ones. The number of rounds grows with the
    logarithm of the longest chain. Rounds are cut by written tables; nothing is collected but a checksum.
    """
    edges = stored(links.select("a", "b").where("a <> b").distinct(), "links")
    last = None
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        low = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").unionByName(
            low.select("a", F.col("m").alias("b"))).distinct()
        edges = stored(small, "stars")
        # Sums of hashes say whether the edges changed.
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(state) == last:
            return edges.groupBy("a").agg(F.min("b").alias("component")).withColumnRenamed("a", "node").unionByName(
                edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
        last = tuple(state)


def join(docs: DataFrame, length: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", rounds: int = 2,
         bucket_bytes: int = 16 << 20) -> DataFrame:
    """``(doc_id, n_shingles, component_id)`` per row of ``docs``, as ``classes`` finds them."""
    return classes(docs, length, percent, id_col, text_col, rounds, bucket_bytes).select(
        public_id(), "n_shingles", public_id("component_id"))


def classes(docs: DataFrame, length: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text", rounds: int = 2,
            bucket_bytes: int = 16 << 20) -> DataFrame:
    """``(doc_id, text_key, n_shingles, class, component_id)`` per row of ``docs``, ids as ``documents`` has them.

    ``text_key`` tells rows apart that share an id; ``class`` is one number per group of linked texts, null without words.
    Words are separated by ASCII white space, with A-Z lowered. Two documents link when their sets of ``length``-word shingles have
    a Jaccard similarity of ``percent`` % or more; a text of fewer words is one shingle, a text without words links with nothing.
    ``component_id`` is the least id that links reach from a document, itself included. Repeated rows are copies of each other.
    """
    spark = docs.sparkSession
    texts = documents(docs, id_col, text_col)
    buckets = block_count(texts, bucket_bytes)
    keyed = texts.select("doc_id", "text", F.xxhash64("text").alias("text_key"))
    keys = stored(keyed.mapInArrow(set_keys(length), "doc_id long, n_shingles long, node long, text_key long, bits array<long>"), "set-keys")
    letters = texts.select("text").mapInArrow(sign_letters(buckets, length, percent), exchange.schema(SENT))
    found = letters.groupBy("bucket").applyInArrow(groups, GROUP).groupBy("gid", "node", "tag").agg(
        F.sum("n").alias("n"), F.max("members").alias("members"), F.max("size").alias("size"), F.max("spare").alias("spare"))
    members = stored(smaller(found), "members")
    wanted = members.select("node").distinct()
    first = keys.join(wanted, "node").groupBy("node").agg(
        F.min(F.struct("doc_id", "text_key", "n_shingles", "bits")).alias("row")).select("node", "row.*")
    # A row repeated whole repeats its text here, and a pair repeats its outcome.
    known = stored(texts.withColumn("text_key", F.xxhash64("text")).join(first, ["doc_id", "text_key"]).select("node", "text"), "set-texts")
    maps = stored(first.select("node", F.col("n_shingles").alias("size"), "bits"), "set-bitmaps")
    links = spark.createDataFrame([], "a long, b long")
    tested, labels = links, spark.createDataFrame([], "node long, component long")
    for turn in range(rounds + 1):
        labelled = members.drop("component").join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
        state = labelled.groupBy("gid").agg(F.min("component").alias("low"), F.max("component").alias("high"))
        members = stored(labelled.join(state.where("low <> high").select("gid"), "gid"), "open-groups")
        if members.isEmpty():
            break
        close = F.least("size", "size_") * 100 >= F.greatest("size", "size_") * percent
        apart = F.col("component") != F.col("component_")
        if turn < rounds:
            # One pivot per group; a set is held against one pivot, the least of another component.
            pivot = members.groupBy("gid").agg(F.min(F.struct(F.xxhash64("node", F.lit(turn)), F.col("node"), F.col("size"), F.col("component"))).alias("p")).select(
                "gid", F.col("p.node").alias("node_"), F.col("p.size").alias("size_"), F.col("p.component").alias("component_"))
            pairs = members.join(pivot, "gid").where(apart & close).groupBy("node").agg(F.min("node_").alias("node_"))
        else:
            # What is left: members of one group that are in different components and whose bitmaps allow them to be similar.
            # The bitmap test is part of the join, so that large groups of sets that are not similar make no rows.
            held = members.join(maps.select("node", "bits"), "node")
            other = held.select("gid", *[F.col(name).alias(f"{name}_") for name in ("node", "size", "component", "spare", "left", "bits")])
            pairs = held.join(other, "gid").where((F.col("node") < F.col("node_")) & apart & close & near(percent, "", "_")).groupBy("node", "node_", "tag").agg(
                F.sum("n").alias("shared"), 
                F.max(F.greatest("spare", "spare_") - F.greatest("left", "left_")).alias("least")).where("shared >= least")
        pairs = pairs.select(F.least("node", "node_").alias("a"), F.greatest("node", "node_").alias("b")).distinct()
        pairs = stored(possible(pairs.join(tested, ["a", "b"], "left_anti"), maps, percent), "pairs")
        tested = tested.unionByName(pairs)
        left, right = (known.select(F.col("node").alias(n), F.col("text").alias(f"text_{n}")) for n in ("a", "b"))
        sides = pairs.join(right, "b").join(left, "a").select("a", "b", "text_a", "text_b")
        links = stored(links.unionByName(sides.mapInArrow(similar(length, percent), "a long, b long")), "verified")
        labels = stored(components(links), "labels")
    joined = keys.join(labels, "node", "left").withColumn(
        "class", F.when(F.col("n_shingles") > 0, F.coalesce("component", "node")))
    least = joined.where("class IS NOT NULL").groupBy("class").agg(F.min("doc_id").alias("component_id"))
    return joined.join(least, "class", "left").select(
        "doc_id", "text_key", "n_shingles", "class", F.coalesce("component_id", "doc_id").alias("component_id"))
