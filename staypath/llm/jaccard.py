"""Exact n-gram Jaccard join with adaptive multi-match prefixes.

Two sets of sizes n and m <= n with Jaccard similarity s or more share t = ceil(s / (1 + s) * (n + m)) tokens or more.
Under any common order of tokens, of which the first p of one and q of the other are looked at, they share at least
t - max(n - p, m - q) of those. With p = n - ceil(s * n) + l and q = m - ceil(2 * s / (1 + s) * m) + l that is l or more.
A longer prefix (a larger l) costs more index entries but asks for more shared tokens, so each document
takes the l with the least estimated cost.

1. Classes: documents with equal sets are one class, known by a 64-bit hash of the set.
2. Filter: under a random order with l = n / 10, a class without enough prefix tokens that other classes'
   prefixes hold has no partner. Tokens travel as packed blocks, each at most once per task.
3. Order: for the classes left, tokens go by document frequency, and each class picks its l.
4. Stars: under each of the first prefix tokens of step 2's order, all classes are compared with the most central
   one there. In further rounds each class is compared with the one, central under a token of its prefix of step 3
   and in another component, that it shares most prefix tokens with.
5. Rest: pairs that meet under enough prefix tokens of step 3's order, and are not in one component yet, are compared.
   A pair that meets under frequent tokens only shares no rare one, as those come first in both prefixes; so at most
   the smaller number of frequent tokens is common. And each class carries a bit table of the tokens it shares with
   others: every bit that one table has and the other lacks is a token that is not common. Both bounds are part of the
   join, so most pairs of a group with edits of their own are never made.
So copies are never expanded into all pairs, and every link between different components is found.
"""

from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from staypath.llm.components import components
from staypath.llm.exchange import HELD, counted, blocks, merge_counts, parts, range_starts
from staypath.llm.frames import discard, documents, forget, merged, packed, staged, unpacked
from staypath.llm.words import Counts, chunks, mix, shingle_hashes, word_hashes, joined

SIZE, PERCENT = 5, 80
#: cost of verifying a pair, in index entries
VERIFY_COST = 8
#: prefix tokens of step 4, and rounds of it over the prefixes of step 3
STARS, ROUNDS = 4, 1
#: tokens of at most so many classes are rare; the pairs under them grow with the number of entries
RARE = 8
#: 64-bit words of a class's bit table; sets of many more tokens fill it, and then it rules nothing out
BITS = 16
#: a fixed second scatter of tokens, the random order of step 2
ORDER = 0x5851F42D4C957F2D


def needed(n, percent):
    """Least overlap of a set of ``n`` tokens with any partner."""
    return -(-n * percent // 100)


def needed_of_larger(n, percent):
    """Least overlap of a set of ``n`` tokens with any partner that is not smaller."""
    return -(-2 * percent * n // (100 + percent))


def first_l(n):
    """How many shared prefix tokens step 2 asks for between sets of this size."""
    return np.maximum(1, n // 10)


def token_sets(data, starts, size):
    """Sorted distinct shingle hashes of each text of a chunk."""
    hashes, at = shingle_hashes(*word_hashes(data, starts), size)
    return [np.unique(hashes[a:b]) for a, b in zip(at, at[1:])]


def class_of(tokens: np.ndarray) -> int:
    """Class of a set: its hash, never 0."""
    return xxhash.xxh3_64_intdigest(tokens.tobytes()) | 1


def _classes(size):
    def run(batches):
        for batch in batches:
            n, cls = [], []
            for _, data, starts in chunks(batch.column("text")):
                for tokens in token_sets(data, starts, size):
                    n.append(len(tokens))
                    cls.append(np.uint64(class_of(tokens)).astype(np.int64).item() if len(tokens) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(n, pa.int64()), pa.array(cls, pa.int64())],
                names=["doc_id", "text_hash", "n_shingles", "cls"])
    return run


SHARED = pa.schema([("part", pa.int32()), ("keys", pa.binary()), ("owners", pa.binary()), ("counts", pa.binary())])
SHARED_DDL = "part int, keys binary, owners binary, counts binary"


def _blocks_met(keys, owners, ranges):
    """Blocks of (token, owner); owner 0 stands for two or more, which are then counted here."""
    order = np.lexsort((owners, keys))
    keys, owners = keys[order], owners[order]
    fresh = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]) | (owners[1:] != owners[:-1])])
    keys, owners = keys[fresh], owners[fresh]
    first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    size = np.diff(np.append(first, len(keys)))
    many = np.repeat(size > 1, size)
    own, n = np.unique(owners[many], return_counts=True)
    keys, owners = keys[first], np.where(size > 1, np.uint64(0), owners[first])
    at = range_starts(keys, ranges)
    used = np.flatnonzero(np.diff(at))
    part = used.tolist() + [int(keys[0] % np.uint64(ranges))]
    return pa.RecordBatch.from_arrays([
        pa.array(part, pa.int32()),
        pa.array([keys[at[i]:at[i + 1]].tobytes() for i in used] + [b""], pa.binary()),
        pa.array([owners[at[i]:at[i + 1]].tobytes() for i in used] + [own.tobytes()], pa.binary()),
        pa.array([b""] * len(used) + [n.astype("<i8").tobytes()], pa.binary())], schema=SHARED)


def _prefixes(size, percent, ranges):
    def run(batches):
        keys, owners, held = [], [], 0
        for batch in batches:
            for _, data, starts in chunks(batch.column("text")):
                for tokens in token_sets(data, starts, size):
                    n = len(tokens)
                    if n:
                        p = n - needed(n, percent) + int(first_l(n))
                        keys.append(tokens[np.argsort(mix(tokens ^ np.uint64(ORDER)))[:p]])
                        owners.append(np.full(len(keys[-1]), class_of(tokens), dtype=np.uint64))
                        held += len(keys[-1])
                if held >= HELD:
                    yield _blocks_met(np.concatenate(keys), np.concatenate(owners), ranges)
                    keys, owners, held = [], [], 0
        if held:
            yield _blocks_met(np.concatenate(keys), np.concatenate(owners), ranges)
    return run


def _owners(table):
    """Of one range: how many tokens of each class other classes have as well."""
    keys = np.frombuffer(b"".join(table.column("keys").to_pylist()), np.uint64)
    counts = table.column("counts").to_pylist()
    blobs = table.column("owners").to_pylist()
    owners = np.frombuffer(b"".join(o for o, c in zip(blobs, counts) if not c), np.uint64)
    owners = owners[:len(keys)]
    done = [np.frombuffer(o, np.uint64) for o, c in zip(blobs, counts) if c]
    n_done = [np.frombuffer(c, "<i8") for c in counts if c]
    order = np.lexsort((owners, keys))
    keys, owners = keys[order], owners[order]
    if len(keys):
        fresh = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]) | (owners[1:] != owners[:-1])])
        keys, owners = keys[fresh], owners[fresh]
        first = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        size = np.diff(np.append(first, len(keys)))
        shared = np.repeat((size > 1) | (owners[first] == 0), size) & (owners != 0)
        own, n = np.unique(owners[shared], return_counts=True)
        done.append(own)
        n_done.append(n)
    own = np.concatenate(done) if done else np.empty(0, np.uint64)
    n = np.concatenate(n_done) if n_done else np.empty(0, np.int64)
    return pa.table({"cls": own.view(np.int64), "n_shared": n.astype(np.int64)})


def survivors(docs: DataFrame, classes: DataFrame, size: int, percent: int) -> DataFrame:
    """``cls, n_shingles`` of the classes that may have a partner."""
    ranges = parts(docs.sparkSession)
    met = docs.select("text").mapInArrow(_prefixes(size, percent, ranges), SHARED_DDL)
    shared = met.groupBy("part").applyInArrow(_owners, "cls bigint, n_shared bigint")
    total = shared.groupBy("cls").agg(F.sum("n_shared").alias("n_shared"))
    known = classes.where("cls is not null").groupBy("cls").agg(
        F.max("n_shingles").alias("n_shingles"), F.min(F.struct("doc_id", "text_hash")).alias("row"))
    least = F.greatest(F.lit(1), F.floor(F.ceil(F.col("n_shingles") * percent / 100) / 10))
    return known.join(total, "cls").where(F.col("n_shared") >= least).select("cls", "n_shingles", "row.*")


def _sets(size):
    def run(batches):
        for batch in batches:
            texts = unpacked(batch.column("text")).to_pylist()
            blobs = []
            for lo in range(0, len(texts), 100):
                blobs += [t.tobytes() for t in token_sets(*joined(texts[lo:lo + 100]), size)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("cls"), batch.column("n_shingles"), pa.array(blobs, pa.binary())], names=["cls", "n", "tokens"])
    return run


def _frequencies(ranges):
    def run(batches):
        counts = Counts()
        for batch in batches:
            for blob in batch.column("tokens").to_pylist():
                counts.add(np.frombuffer(blob, np.uint64))
        keys, n = counts.total()
        if len(keys):
            yield blocks(keys, n, ranges)
    return run


def _frequent(table):
    keys, n = merge_counts(table)
    return pa.table({"token": keys[n > 1].view(np.int64), "df": n[n > 1]})


def _exploded(batches):
    for batch in batches:
        for cls, n, blob in zip(*(batch.column(c).to_pylist() for c in ("cls", "n", "tokens"))):
            tokens = np.frombuffer(blob, np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(tokens), pa.array(np.full(len(tokens), cls)), pa.array(np.full(len(tokens), n))], names=["token", "cls", "n"])


def choose_l(n: int, df: np.ndarray, percent: int) -> int:
    """The l of least estimated cost for a set of ``n`` tokens whose shared ones, rarest first, have frequencies ``df``.

    A prefix is scanned at the cost of its tokens' frequencies; each candidate takes l of those hits.
    """
    alone = n - len(df)
    scan = np.concatenate([[0], np.cumsum(df - 1)])
    best, cost = 1, None
    l = 1
    while l <= max(1, needed(n, percent) // 4):
        hits = scan[max(0, min(n, n - needed(n, percent) + l) - alone)]
        now = hits + VERIFY_COST * hits / l
        if cost is None or now < cost:
            best, cost = l, now
        l *= 2
    return best


INDEX = pa.schema([("token", pa.int64()), ("cls", pa.int64()), ("n", pa.int64()), ("shared", pa.int64()), ("common", pa.int64()),
                   ("l", pa.int32()), ("inner", pa.bool_()), ("rare", pa.bool_()), ("bits", pa.list_(pa.int64()))])
INDEX_DDL = "token bigint, cls bigint, n bigint, shared bigint, common bigint, l int, inner boolean, rare boolean, bits array<bigint>"


def bit_table(tokens: np.ndarray) -> np.ndarray:
    """A bit for the hash of each token."""
    at = (mix(tokens.view(np.uint64)) >> np.uint64(32)).astype(np.int64) % (64 * BITS)
    out = np.zeros(64 * BITS, dtype=np.uint8)
    out[at] = 1
    return np.packbits(out, bitorder="little").view("<i8")


def _index(percent):
    """Prefix entries of each set, and with l = 0 its first shared tokens in the random order.

    ``inner`` entries are those looked at when the partner is larger.
    """
    def run(batches):
        for batch in batches:
            out, bits = [[] for _ in INDEX.names[:-1]], []
            for cls, n, pairs in zip(batch.column("cls").to_pylist(), batch.column("n").to_pylist(), batch.column("pairs")):
                df, token = (pairs.values.field(f).to_numpy() for f in ("df", "token"))
                order = np.lexsort((token, df))
                df, token = df[order], token[order]
                heads = token[np.argsort(mix(token.view(np.uint64) ^ np.uint64(ORDER)))[:STARS]]
                l = choose_l(n, df, percent)
                keep = max(0, min(n, n - needed(n, percent) + l) - (n - len(df)))
                each = np.r_[np.zeros(len(heads), dtype=np.int32), np.full(keep, l, dtype=np.int32)]
                close = max(0, n - needed_of_larger(n, percent) + l - (n - len(df)))
                inner = np.arange(len(each)) < len(heads) + close
                same = lambda value: np.full(len(each), value)
                rare = np.r_[np.zeros(len(heads), dtype=bool), df[:keep] <= RARE]
                made = np.r_[heads, token[:keep]], same(cls), same(n), same(len(df)), same(int((df > RARE).sum())), each, inner, rare
                for column, values in zip(out, made):
                    column.append(values)
                # only entries of frequent tokens are met by way of the table
                own = bit_table(token)
                bits += [None if r or not e else own for r, e in zip(rare.tolist(), each.tolist())]
            columns = [pa.array(np.concatenate(c) if c else [], f.type) for c, f in zip(out, INDEX)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(bits, INDEX.field("bits").type)], schema=INDEX)
    return run


def _possible(percent: int, known: str = "shared") -> F.Column:
    """Whether sizes allow a link if at most the smaller number of ``known`` tokens is common to a and b."""
    both = F.least(f"{known}_a", f"{known}_b")
    return ((100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b"))
            & (100 * both >= percent * (F.col("n_a") + F.col("n_b") - both)))


def _bits_allow(percent: int) -> F.Column:
    """Whether the bit tables allow a link: tokens of a whose bit b lacks are not in b, and the other way round."""
    def side(x, y):
        # as a function of arrays it is not unrolled into the join's generated code, which stays small enough to be compiled
        lacking = f"aggregate(zip_with(bits_{x}, bits_{y}, (i, j) -> bit_count(i & ~j)), 0, (s, c) -> s + c)"
        return F.expr(f"{100 + percent} * (shared_{x} - {lacking}) >= {percent} * (n_a + n_b)")

    return side("a", "b") & side("b", "a")


def _verified(percent):
    def run(batches):
        for batch in batches:
            keep = []
            for a, b in zip(batch.column("tokens_a").to_pylist(), batch.column("tokens_b").to_pylist()):
                a, b = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
                both = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(100 * both >= percent * (len(a) + len(b) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return run


def _links(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs a, b whose sets are similar enough."""
    side = lambda k: sets.select(F.col("cls").alias(k), F.col("tokens").alias(f"tokens_{k}"))
    both = pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b")
    return staged(both.select("a", "b", "tokens_a", "tokens_b").mapInArrow(_verified(percent), "a bigint, b bigint"))


def _candidates(met: DataFrame, percent: int) -> DataFrame:
    """From a row per shared prefix token of a and the smaller b: the pairs with enough of them."""
    whole = 100 + percent
    overlap = f"({percent} * (n_a + n_b) + {whole - 1}) div {whole}"
    rest_a = f"(n_a * {percent} + 99) div 100 - l_a"
    rest_b = f"(2 * {percent} * n_b + {whole - 1}) div {whole} - l_b"
    least = F.expr(f"{overlap} - greatest({rest_a}, {rest_b})")
    return met.groupBy("a", "b").agg(F.count("*").alias("hits"), F.max(least).alias("least")).where("hits >= least")


def _side(rows: DataFrame, k: str) -> DataFrame:
    return rows.withColumnsRenamed({"cls": k, **{c: f"{c}_{k}" for c in ("n", "shared", "common", "l", "inner", "rare", "component", "bits")}})


def _indexed(docs: DataFrame, size: int, percent: int):
    """Stored tables of steps 1 to 3: the class of each row, the sets of the classes left, and their index entries."""
    spark = docs.sparkSession
    ddl = "doc_id bigint, text_hash bigint, n_shingles bigint, cls bigint"
    classes = staged(docs.mapInArrow(_classes(size), ddl))
    left = staged(survivors(docs, classes, size, percent))
    forget(spark)
    kept = merged(packed(docs), left, how="inner").select("cls", "n_shingles", "text")
    sets = staged(kept.mapInArrow(_sets(size), "cls bigint, n bigint, tokens binary"))
    discard(left)
    forget(spark)
    ranges = parts(spark, 1)
    frequency = counted(sets, _frequencies(ranges), _frequent, "token bigint, df bigint")
    tokens = sets.mapInArrow(_exploded, "token bigint, cls bigint, n bigint").join(frequency, "token")
    ordered = tokens.groupBy("cls", "n").agg(F.collect_set(F.struct("df", "token")).alias("pairs"))
    entries = staged(ordered.mapInArrow(_index(percent), INDEX_DDL))
    forget(spark)
    return classes, sets, entries


def _met(entries: DataFrame, apart: F.Column, percent: int) -> DataFrame:
    """Pairs a and the smaller b that meet under tokens of their prefixes and that no bound rules out."""
    smaller = F.struct("n_b", "b") < F.struct("n_a", "a")
    meet = lambda rows: _side(rows, "a").join(_side(rows.where("inner"), "b"), "token").where(apart & smaller)
    by_rare = meet(entries.where("rare")).where(_possible(percent)).select("a", "b")
    by_frequent = meet(entries.where("not rare")).where(_possible(percent, "common") & _bits_allow(percent))
    return by_rare.unionByName(_candidates(by_frequent, percent).select("a", "b")).distinct()


def class_links(docs: DataFrame, size: int = SIZE, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """Members ``doc_id, text_hash, n_shingles, cls, n_links``, and all links ``a, b`` between classes of equal sets.

    Equal sets are one class, so copies are never paired; ``n_links`` counts the other classes a row's class is linked
    with. The links are as many as there are pairs of similar different texts.
    """
    classes, sets, entries = _indexed(documents(docs), size, percent)
    links = _links(_met(entries.where("l > 0"), F.lit(True), percent), sets, percent)
    ends = links.select(F.explode(F.array("a", "b")).alias("cls")).groupBy("cls").agg(F.count("*").alias("n_links"))
    members = classes.join(ends, "cls", "left").select("doc_id", "text_hash", "n_shingles", "cls", F.coalesce("n_links", F.lit(0)).alias("n_links"))
    return members, links


def grouped(docs: DataFrame, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """``doc_id, text_hash, n_shingles, group`` of ``documents`` rows; rows without words have no group."""
    classes, sets, entries = _indexed(docs, size, percent)
    heads, index = entries.where("l = 0").drop("l", "inner", "rare", "bits"), entries.where("l > 0")
    # the centre of a group of copies has the fewest tokens of its own
    own = (F.col("n") - F.col("shared")) / F.col("n")
    hub = heads.groupBy("token").agg(F.min(F.struct(own.alias("own"), "cls", "n", "shared")).alias("hub"), F.count("*").alias("held"))
    hubs = hub.where("held > 1").select("token", "hub.cls", "hub.n", "hub.shared")
    met = _side(heads, "a").join(_side(hubs, "b"), "token").where((F.col("a") != F.col("b")) & _possible(percent))
    stars = _links(met.select("a", "b").distinct(), sets, percent)
    group = components(stars)
    links, tested = [stars], []
    for _ in range(ROUNDS):
        known = index.join(group.withColumnRenamed("node", "cls"), "cls", "left").withColumn("component", F.coalesce("component", "cls"))
        hub = known.groupBy("token").agg(F.min(F.struct(own.alias("own"), "cls", "n", "shared", "component")).alias("hub"))
        hubs = hub.select("token", "hub.cls", "hub.n", "hub.shared", "hub.component")
        met = _side(known, "a").join(_side(hubs, "b"), "token").where((F.col("component_a") != F.col("component_b")) & _possible(percent))
        hits = met.groupBy("a", "b").agg(F.count("*").alias("hits"))
        if tested:
            hits = hits.join(reduce(DataFrame.unionByName, tested), ["a", "b"], "left_anti")
        tested.append(staged(hits.groupBy("a").agg(F.max_by("b", F.struct("hits", "b")).alias("b"))))
        links.append(_links(tested[-1], sets, percent))
        group = components(reduce(DataFrame.unionByName, links))
    known = staged(index.join(group.withColumnRenamed("node", "cls"), "cls", "left").withColumn("component", F.coalesce("component", "cls")))
    mixed = known.groupBy("token").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high").select("token")
    open_rows = known.join(mixed, "token")
    links.append(_links(_met(open_rows, F.col("component_a") != F.col("component_b"), percent), sets, percent))
    discard(entries, sets, known, *tested)
    final = components(reduce(DataFrame.unionByName, links)).withColumnRenamed("node", "cls")
    discard(*links)
    return classes.join(final, "cls", "left").select("doc_id", "text_hash", "n_shingles", F.coalesce("component", "cls").alias("group"))


def near_copies(docs: DataFrame, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """Per row: ``doc_id, n_shingles, component_id``, the least doc_id that links lead to.

    Words are lower-cased (A-Z) runs of bytes other than space and 0x09 to 0x0D; a set is the distinct
    ``size``-word shingles of a text, or its whole word sequence if that is shorter. Texts without words (null,
    empty) have no link and are their own component, as are rows without id that are alone.
    """
    rows = grouped(documents(docs), size, percent)
    least = rows.where("group is not null").groupBy("group").agg(F.min("doc_id").alias("least"))
    return rows.join(least, "group", "left").select(
        "doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("least")).otherwise(F.col("doc_id")).alias("component_id"))


def drop_near_copies(docs: DataFrame, size: int = SIZE, percent: int = PERCENT) -> DataFrame:
    """One row of each component, with all columns of ``docs``: the one with the least id, rows without id last.

    Rows without words all stay; of repeated rows one stays.
    """
    last = F.coalesce(F.col("doc_id").cast("bigint"), F.lit((1 << 63) - 1))
    rows = grouped(documents(docs), size, percent).withColumn("key", F.struct(last.alias("id"), "text_hash"))
    kept = rows.where("group is not null").groupBy("group").agg(F.min("key").alias("key")).select("key.*").unionByName(
        rows.where("group is null").select("key.*").distinct())
    text = F.col("text").cast("string")
    keyed = docs.select(F.struct("*").alias("row"), last.alias("id"), F.xxhash64(text).alias("text_hash"))
    return keyed.join(kept.hint("shuffle_hash"), ["id", "text_hash"]).dropDuplicates(["id", "text_hash"]).select("row.*")
