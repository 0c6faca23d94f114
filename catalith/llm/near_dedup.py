"""Near-duplicate groups by SuperMinHash signatures, banding, verification and union-find.

Every document becomes the set of its distinct word shingles. Documents with equal
sets are one class from the start, so copies never multiply. Each class gets a
signature of `SIGNATURE` correlated permutation ranks; `BANDS` groups of them are
bucket keys. Candidates are confirmed on the full sets, and confirmed links joined to
components.

No bucket is capped and no bucket's pairs are listed. First every member of a bucket is
compared with the bucket's smallest member only. Buckets whose members are in one
component then are done: that is the end for most large groups of copies. In the others
the members outside the bucket's main component ask all members, in blocks, by
signature, and each one's best partners are confirmed. Those that are still outside are
compared on the full sets with every member that is not in their component, inside the
tasks; only links come out.

A document of fewer than `WIDTH` words is one shingle; null, empty and wordless texts
have no set and stay alone. Repeated ids count as one document if their texts agree;
else each text's links apply to the id. A null id has no links: its row is kept unless
a document with an id has the same set. Other columns are not read, and `without` returns
them as they are, whatever their names. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalith.checkpoints import stage, staging_folder
from catalith.llm import sieve, wordscan
from catalith.llm.components import Forest, components
from catalith.llm.names import unused

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WIDTH = 5
SHARE = (75, 100)  # least intersection over union
SIGNATURE, BANDS = 128, 32
# Below this estimated similarity a pair is not worth confirming: over five standard errors under 0.75.
ESTIMATE = 0.55
# Members that are compared with one copy of a centre, and rows of a block of a bucket.
MEMBERS_PER_TASK, BLOCK_ROWS = 64, 512
# Partners of an asker in a block that are confirmed before all are.
BEST = 4


def shingle_sets(block: wordscan.Block) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of each text, from cryptographic digests of its words."""
    digests = block.word_digests()
    hashes = block.window_hashes(digests[:, 0], WIDTH)
    for i, n in enumerate(block.counts.tolist()):
        a = int(block.first[i])
        if n >= WIDTH:
            yield np.unique(hashes[a : a + n - WIDTH + 1])
        elif n:
            yield block.window_hashes(digests[a : a + n, 1], n, family=1)
        else:
            yield np.zeros(0, np.uint64)


def super_minhash(items: np.ndarray, size: int = SIGNATURE) -> np.ndarray:
    """SuperMinHash of a set of hashes (Ertl 2017), level by level over all items at once.

    Item x draws a random permutation of the places and, at level j, offers j plus a
    random fraction to the j-th place of it. A place keeps the least offer. Once every
    place has one of a level below j, later levels cannot change anything: large sets
    need the first level only.
    """
    n = len(items)
    best = np.full(size, np.inf)
    order = None
    for j in range(size):
        draw = wordscan.mixed(items + np.uint64(0x9E3779B97F4A7C15 * (j + 1) & (1 << 64) - 1))
        fraction = (draw >> np.uint64(11)).astype(np.float64) * 2.0**-53
        other = wordscan.mixed(draw ^ np.uint64(0xD1B54A32D192ED03))
        pick = j + ((other >> np.uint64(32)) * np.uint64(size - j) >> np.uint64(32)).astype(np.int64)
        if j == 0:
            place = pick
        else:
            if order is None:
                # The permutations so far differ from the identity by the first exchange.
                order = np.tile(np.arange(size, dtype=np.int16), (n, 1))
                order[rows := np.arange(n), first] = 0
                order[rows, 0] = first
            place = order[rows, pick].astype(np.int64)
            order[rows, pick] = order[rows, j]
            order[rows, j] = place
        if j == 0:
            first = pick
        np.minimum.at(best, place, j + fraction)
        if best.max() < j + 1:
            break
    return best


def _signatures(docs: DataFrame, doc: str, text: str) -> DataFrame:
    """(doc, text_key, n_shingles, set_id, bands, sketch): sketch holds a byte of each rank, for estimates."""
    kind = docs.schema[doc].dataType.simpleString()

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = wordscan.Scanner(lower=True)
        for batch in batches:
            for lo, hi, block in scanner.blocks(batch.column(1)):
                sizes, ids, bands, sketches = [], [], [], []
                for items in shingle_sets(block):
                    sizes.append(len(items))
                    if not len(items):
                        ids.append(None), bands.append(None), sketches.append(None)
                        continue
                    ids.append(hashlib.blake2b(items.tobytes(), digest_size=16).digest())
                    ranks = wordscan.mixed(super_minhash(items).view(np.uint64))
                    keys = ranks.reshape(BANDS, -1)
                    key = wordscan.mixed(np.arange(BANDS, dtype=np.uint64))
                    for c in range(keys.shape[1]):
                        key = wordscan.mixed(key ^ keys[:, c])
                    bands.append(key.view(np.int64))
                    sketches.append((ranks >> np.uint64(56)).astype(np.uint8).tobytes())
                yield pa.record_batch(
                    [batch.column(0).slice(lo, hi - lo), batch.column(2).slice(lo, hi - lo), pa.array(sizes, pa.int64()),
                     pa.array(ids, pa.binary()), pa.array(bands, pa.list_(pa.int64())), pa.array(sketches, pa.binary())],
                    ["doc", "text_key", "n_shingles", "set_id", "bands", "sketch"],
                )

    rows = docs.select(F.col(doc), F.col(text).alias("_text"), F.xxhash64(text).alias("_text_key"))
    schema = f"doc {kind}, text_key bigint, n_shingles bigint, set_id binary, bands array<bigint>, sketch binary"
    return rows.mapInArrow(scan, schema)


def alike(x: np.ndarray, y: np.ndarray) -> bool:
    small, large = sorted((len(x), len(y)))
    if SHARE[1] * small < SHARE[0] * large:
        return False
    shared = len(np.intersect1d(x, y, assume_unique=True))
    return SHARE[1] * shared >= SHARE[0] * (len(x) + len(y) - shared)


def _texts_of(docs: DataFrame, ids: DataFrame, doc: str, text: str, held: list[Broadcast]) -> DataFrame:
    """(doc, text) of the documents of `ids` and a few more, told by a bit table without a shuffle.

    The table joins `held`, to be destroyed once the result is written.
    """
    spark = docs.sparkSession
    known = spark.sparkContext.broadcast(sieve.build(ids.select(F.xxhash64("doc").alias("k")), "k").parts)
    held.append(known)
    texts = docs.select(F.col(doc).alias("doc"), F.xxhash64(doc).alias("_k"), F.col(text).alias("text"))

    def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sifted = sieve.Sieve(*known.value)
        for batch in batches:
            yield batch.filter(pa.array(sifted.passes(batch.column(1).to_numpy())))

    return texts.mapInArrow(sift, texts.schema).drop("_k")


def _confirmed(docs: DataFrame, pairs: DataFrame, doc: str, text: str, held: list[Broadcast]) -> DataFrame:
    """The pairs (a, b) whose full shingle sets are alike. Texts are shuffled for the documents of pairs only.

    All partners b of one a are compared in a stream, a's sets held in memory; an a with
    many partners is copied for every `MEMBERS_PER_TASK` of them.
    """
    spark, kind = docs.sparkSession, docs.schema[doc].dataType.simpleString()
    parts = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / MEMBERS_PER_TASK).alias("_parts"))
    spread = pairs.join(parts, "a").select("a", "b", F.pmod(F.xxhash64("b"), F.col("_parts")).alias("part"))
    heads = parts.select("a", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_parts") - 1)).alias("part"))
    wanted = heads.select(F.col("a").alias("doc"), "a", "part").unionByName(
        spread.select(F.col("b").alias("doc"), "a", "part")
    )
    wanted = stage(wanted, staging_folder(spark), "wanted")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner, head, head_sets = wordscan.Scanner(lower=True), None, {}
        for batch in batches:
            found = []
            for lo, hi, block in scanner.blocks(batch.column(3)):
                part = batch.slice(lo, hi - lo)
                keys = zip(part.column(0).to_pylist(), part.column(1).to_pylist(), part.column(2).to_pylist(), strict=True)
                for (a, p, d), items in zip(keys, shingle_sets(block), strict=True):
                    if d == a:
                        if head != (a, p):
                            head, head_sets = (a, p), {}
                        # A repeated id has several texts; equal ones are held once.
                        head_sets[hashlib.blake2b(items.tobytes(), digest_size=16).digest()] = items
                    elif head == (a, p) and any(alike(x, items) for x in head_sets.values()):
                        found.append((a, d))
            kinds = batch.schema.field(0).type
            yield pa.record_batch([pa.array([f[0] for f in found], kinds), pa.array([f[1] for f in found], kinds)], ["a", "b"])

    texts = _texts_of(docs, wanted.select("doc"), doc, text, held)
    rows = texts.join(wanted, "doc").select("a", "part", "doc", "text")
    # The head of each part comes first. Rows of one part are together, but a part is small.
    ordered = rows.repartition("a", "part").sortWithinPartitions("a", "part", F.col("doc") != F.col("a"))
    return ordered.mapInArrow(compare, f"a {kind}, b {kind}")


def _placed(rows: DataFrame, labels: DataFrame) -> DataFrame:
    placed = rows.join(labels.withColumnRenamed("node", "rep"), "rep", "left")
    return placed.withColumn("component", F.coalesce("component", "rep"))


def _open_buckets(buckets: DataFrame, labels: DataFrame, sketches: DataFrame) -> DataFrame:
    """Rows of the buckets whose members are in several components: asks, block counts, component, sketch.

    `asks` marks the members outside the bucket's largest component: of two members in
    different components at least one asks.
    """
    placed = _placed(buckets, labels)
    per = placed.groupBy("key", "component").agg(F.count(F.lit(1)).alias("n"))
    whole = per.groupBy("key").agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("parts"), F.max(F.struct("n", "component")).alias("main")
    )
    # A bucket of two was decided by comparing the two.
    several = whole.where("parts > 1 and n > 2").select(
        "key",
        F.col("main.component").alias("main"),
        F.ceil(F.col("n") / BLOCK_ROWS).alias("m_blocks"),
        F.ceil((F.col("n") - F.col("main.n")) / BLOCK_ROWS).alias("q_blocks"),
    )
    rows = placed.join(several, "key").withColumn("asks", F.col("component") != F.col("main")).drop("main")
    return rows.join(sketches, "rep")


def _meetings(rows: DataFrame) -> DataFrame:
    """(key, m, q, role, ...): blocks of askers (role 0) and of members (role 1) of a bucket that meet in one task."""
    kept = ["rep", "component", "sketch"]

    def own(blocks: str) -> Column:
        return F.pmod(F.xxhash64("rep"), F.col(blocks))

    def every(blocks: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(blocks) - 1))

    as_member = rows.select("key", own("m_blocks").alias("m"), every("q_blocks").alias("q"), F.lit(1).alias("role"), *kept)
    as_asker = rows.where("asks").select("key", every("m_blocks").alias("m"), own("q_blocks").alias("q"), F.lit(0).alias("role"), *kept)
    return as_member.unionByName(as_asker)


def _asked(rows: DataFrame) -> DataFrame:
    """Pairs (a, b) in different components that are alike by estimate: the best of each asker in each block."""
    kind = rows.schema["rep"].dataType.simpleString()

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, askers, members = None, [], []

        def pairs() -> list:
            if not askers or not members:
                return []
            sides = [np.frombuffer(b"".join(x[1] for x in s), np.uint8).reshape(len(s), -1) for s in (askers, members)]
            out, ids = [], np.array([m[0] for m in members], object)
            homes = np.array([m[2] for m in members], object)
            for (rep, _, home), sketch in zip(askers, sides[0], strict=True):
                alike = (sides[1] == sketch).mean(axis=1)
                ranked = np.argsort(-alike, kind="stable")
                ranked = ranked[alike[ranked] >= ESTIMATE]
                ranked = [k for k in ranked.tolist() if homes[k] != home][:BEST]
                out += [(min(rep, ids[k]), max(rep, ids[k])) for k in ranked]
            return out

        for batch in batches:
            found = []
            for key, m, q, role, rep, home, sketch in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (key, m, q) != group:
                    found += pairs()
                    group, askers, members = (key, m, q), [], []
                (members if role else askers).append((rep, sketch, home))
            t = batch.schema.field(4).type
            yield pa.record_batch([pa.array([f[0] for f in found], t), pa.array([f[1] for f in found], t)], ["a", "b"])
        found = pairs()
        if found:
            yield pa.record_batch([pa.array([f[0] for f in found], t), pa.array([f[1] for f in found], t)], ["a", "b"])

    both = _meetings(rows).repartition("key", "m", "q").sortWithinPartitions("key", "m", "q", "role")
    return both.mapInArrow(ask, f"a {kind}, b {kind}").distinct()


def _compared(docs: DataFrame, rows: DataFrame, doc: str, text: str, held: list[Broadcast]) -> DataFrame:
    """Links (a, b) between components, from comparing every asker with every member of its bucket on the full sets.

    Nothing but links is put out, and of these only such as join two components that the
    task has not joined yet. Askers of one meeting are held in memory, members stream by.
    """
    kind = rows.schema["rep"].dataType.simpleString()
    wanted = stage(_meetings(rows).withColumnRenamed("rep", "doc"), staging_folder(docs.sparkSession), "meetings")
    placed = _texts_of(docs, wanted.select("doc"), doc, text, held).join(wanted, "doc")
    placed = placed.select("key", "m", "q", "role", "doc", "component", "sketch", "text")
    ordered = placed.repartition("key", "m", "q").sortWithinPartitions("key", "m", "q", "role")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner, group, askers, sketches, forest = wordscan.Scanner(lower=True), None, [], None, Forest()
        for batch in batches:
            found = []
            for lo, hi, block in scanner.blocks(batch.column(7)):
                part = batch.slice(lo, hi - lo).drop_columns(["text"])
                facts = zip(*(c.to_pylist() for c in part.columns), strict=True)
                for (key, m, q, role, d, home, sketch), items in zip(facts, shingle_sets(block), strict=True):
                    if (key, m, q) != group:
                        group, askers, sketches = (key, m, q), [], None
                    if role == 0:
                        askers.append((d, home, items, sketch))
                        continue
                    if sketches is None:
                        sketches = np.frombuffer(b"".join(a[3] for a in askers), np.uint8).reshape(len(askers), -1)
                    likely = np.flatnonzero((sketches == np.frombuffer(sketch, np.uint8)).mean(axis=1) >= ESTIMATE)
                    for asker, own, theirs, _ in (askers[k] for k in likely.tolist()):
                        if own != home and forest.root(own) != forest.root(home) and alike(theirs, items):
                            forest.join(own, home)
                            found.append((asker, d))
            t = batch.schema.field(4).type
            yield pa.record_batch([pa.array([f[0] for f in found], t), pa.array([f[1] for f in found], t)], ["a", "b"])

    return ordered.mapInArrow(compare, f"a {kind}, b {kind}")


def near_duplicates(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: id, n_shingles, component_id (smallest id reachable), kept."""
    return judged(docs, doc, text).drop("text_key")


def judged(docs: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of near_duplicates, with `text_key`, the hash of the text that each row judges."""
    spark = docs.sparkSession
    folder = staging_folder(spark)
    signed = stage(_signatures(docs, doc, text), folder, "signatures")
    sets = signed.where("set_id is not null and doc is not null")
    classes = sets.groupBy("set_id").agg(F.min("doc").alias("rep"), F.min_by(F.struct("bands", "sketch"), "doc").alias("s"))
    classes = stage(classes.select("set_id", "rep", "s.bands", "s.sketch"), folder, "classes")
    every = classes.select(F.explode("bands").alias("key"), "rep")
    heads = every.groupBy("key").agg(F.min("rep").alias("a"), F.count(F.lit(1)).alias("n")).where("n > 1")
    # A table of its own, so that both sides of the join are shuffled and a hot bucket is split.
    heads = stage(heads.select("key", "a"), folder, "heads")
    buckets = stage(every.join(heads, "key").select("key", "rep", "a"), folder, "buckets")
    firsts = buckets.where("rep <> a").select("a", F.col("rep").alias("b")).distinct()
    held: list[Broadcast] = []

    def written(links: DataFrame, name: str) -> DataFrame:
        links = stage(links, folder, name)
        while held:
            held.pop().destroy()
        return links

    links = written(_confirmed(docs, stage(firsts, folder, "pairs_0"), doc, text, held), "links_0")
    labels = components(links, "a", "b")

    sketches = classes.select("rep", "sketch")
    members = buckets.select("key", "rep")
    # Most members that missed their bucket's centre find a link among their best partners.
    asked = _asked(_open_buckets(members, labels, sketches)).join(firsts, ["a", "b"], "left_anti")
    links = links.unionByName(written(_confirmed(docs, stage(asked, folder, "pairs_1"), doc, text, held), "links_1"))
    labels = components(links, "a", "b")
    # What is left is compared with everybody.
    last = _compared(docs, _open_buckets(members, labels, sketches), doc, text, held)
    labels = components(links.unionByName(written(last, "links_2")), "a", "b")
    named = labels.withColumnRenamed("node", "rep")
    homes = classes.select("set_id", "rep").join(named, "rep", "left")
    # A table of its own, so that copies of one text can be split when they look up their component.
    homes = stage(homes.select("set_id", F.coalesce("component", "rep").alias("component")), folder, "homes")
    found = signed.join(homes, "set_id", "left")
    component = F.coalesce("component", "doc")
    return found.select(
        F.col("doc").alias(doc),
        "n_shingles",
        component.alias("component_id"),
        component.eqNullSafe(F.col("doc")).alias("kept"),
        "text_key",
    )


def without(docs: DataFrame, rows: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that `rows` (of `judged`) keeps, and one of those with equal id and text.

    Decided by (id, text), null ids included; only rows that a bit table suspects are looked up and shuffled.
    """
    spark = docs.sparkSession
    per = rows.groupBy(F.col(doc).alias("_doc"), F.col("text_key").alias("_text_key")).agg(
        F.bool_and("kept").alias("_kept"), F.count(F.lit(1)).alias("_n")
    )
    touched = stage(per.where("not _kept or _n > 1"), staging_folder(spark), "touched")
    known = spark.sparkContext.broadcast(sieve.build(touched.select(F.xxhash64("_doc", "_text_key").alias("k")), "k").parts)
    (key,) = unused(docs, "_key")
    keyed = docs.withColumn(key, F.xxhash64(doc, F.xxhash64(text)))
    gone = touched.where("not _kept").select("_doc", "_text_key").toDF(*unused(docs, "_doc", "_text_key"))

    def part(suspected: bool) -> DataFrame:
        def sift(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            sifted = sieve.Sieve(*known.value)
            for batch in batches:
                yield batch.filter(pa.array(sifted.passes(batch.column(batch.num_columns - 1).to_numpy()) == suspected))

        return keyed.mapInArrow(sift, keyed.schema).drop(key)

    same = F.col(doc).eqNullSafe(F.col(gone.columns[0])) & (F.xxhash64(text) == F.col(gone.columns[1]))
    left = part(True).join(gone, same, "left_anti")
    return part(False).unionByName(left.dropDuplicates([doc, text]))
