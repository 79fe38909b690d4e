"""Near duplicates by SetSketch registers, banded, estimated by joint likelihood and verified.

A register is the least of exponential values of a set's elements, cut off to a whole power of BASE:
registers of unions are maxima, and equal ones become likelier with the sets' similarity. Documents
that agree in all registers of a band are candidates. The likelihood of the registers' order, given
both sizes, sorts out most; full shingle sets decide the rest.

Groups are never turned into all pairs. Equal sets are one node. A bucket's members are compared
with few of them (pivots); what is still unconnected is compared in blocks, inside tasks.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fallowfunds.llm import bloom
from fallowfunds.llm.common import packed, quoted, released, stored, unpacked, whole
from fallowfunds.llm.components import components
from fallowfunds.llm.flat import Hasher, buffers, chunks, mix, shingles, words

WORDS = 5
PERCENT = 80  # similarity that links two documents
BASE = 1.02  # spacing of register values
BANDS, ROWS = 24, 4  # two sets of similarity 0.8 miss each other once in 300,000 times; of 0.85, in 50 million
REGISTERS = BANDS * ROWS
SLACK = 0.2  # over five standard deviations of the estimate at 0.8
BLOCK = 64  # values drawn at once for the few elements that need many
PIVOTS = 8  # of a bucket, in the second round
FILTER_BYTES = 16 << 20  # of a Bloom filter of rows whose texts are needed; a fuller one lets more through
GROUP = 512  # members compared with one copy of a pivot, or held as one block


def distinct_shingles(data: np.ndarray, offsets: np.ndarray, n: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(sorted distinct hashes of the rows' shingles, end to end; offsets of the rows in them)."""
    start, end, row = words(data, offsets)
    hashed, row = shingles(Hasher(data, lower=True)(start, end), row, n)
    count = np.bincount(row, minlength=len(offsets) - 1)
    at = np.append(0, np.cumsum(count))
    sets = [np.unique(hashed[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)]
    return np.concatenate([np.zeros(0, np.uint64), *sets]), np.append(0, np.cumsum([len(s) for s in sets])).astype(np.int64)


def registers(hashed: np.ndarray, offsets: np.ndarray, m: int = REGISTERS) -> np.ndarray:
    """(rows, m) registers. An element's values are points of a random process, dealt to registers at
    random; those beyond a row's largest least value cannot count and are not drawn."""
    n_rows = len(offsets) - 1
    row = np.repeat(np.arange(n_rows), np.diff(offsets))
    least = np.full(n_rows * m, np.inf)
    x, seed, drawn = np.zeros(len(hashed)), hashed, 0
    while len(seed):
        k = BLOCK if len(seed) < 4096 and drawn > 1 else 1
        step = np.arange(drawn + 1, drawn + k + 1, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95)
        u = mix((seed[:, None] + step).ravel()).reshape(-1, k)
        drawn += k
        points = x[:, None] + np.cumsum(-np.log(((u >> np.uint64(32)) + 0.5) / 2.0**32) / m, axis=1)
        spot = ((u & np.uint64(0xFFFFFFFF)) * np.uint64(m)) >> np.uint64(32)
        np.minimum.at(least, (row[:, None] * m + spot.astype(np.int64)).ravel(), points.ravel())
        x = points[:, -1]
        more = x < least.reshape(n_rows, m).max(axis=1)[row]
        x, seed, row = x[more], seed[more], row[more]
    with np.errstate(divide="ignore"):
        value = np.floor(1 - np.log(least) / np.log(BASE))
    value[~np.isfinite(value)] = 0  # a row without elements
    return np.clip(value + 2000, 0, 65535).astype(np.uint16).reshape(n_rows, m)


def band_keys(table: np.ndarray) -> np.ndarray:
    """(rows, BANDS): a hash of the registers in each band."""
    packed = np.ascontiguousarray(table).view(np.uint64).reshape(len(table), BANDS)
    return mix((packed + np.arange(1, BANDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).ravel()).reshape(-1, BANDS)


def estimate(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Similarity that makes the registers' order likeliest, given both sizes."""
    m = a.shape[1]
    above, below = (a > b).sum(axis=1), (a < b).sum(axis=1)
    same = m - above - below
    u = n_a / (n_a + n_b)
    v = 1 - u
    grid = np.linspace(0, 1, 129)[None, :] * np.minimum(u / v, v / u)[:, None]
    p = lambda x: -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)
    more, less = p(u[:, None] - v[:, None] * grid), p(v[:, None] - u[:, None] * grid)
    log = lambda x: np.log(np.maximum(x, 1e-12))
    likely = above[:, None] * log(more) + below[:, None] * log(less) + same[:, None] * log(1 - more - less)
    return grid[np.arange(len(a)), likely.argmax(axis=1)]


def sketch(docs: DataFrame) -> DataFrame:
    """(key, id, n, xor, sum, registers, bands) of every row (key, id, text); xor and sum tell equal sets."""

    def run(batches):
        for batch in batches:
            for first, last, data, offsets in chunks(batch.column(2)):
                hashed, at = distinct_shingles(data, offsets)
                size = np.diff(at)
                table = registers(hashed, at)
                spread = mix(hashed)
                parts = [spread[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]
                xor = np.array([np.bitwise_xor.reduce(p) for p in parts], np.uint64)
                total = np.array([p.sum(dtype=np.uint64) for p in parts], np.uint64)
                keys = band_keys(table).view(np.int64).ravel()
                bands = pa.ListArray.from_arrays(pa.array(np.arange(len(size) + 1, dtype=np.int32) * BANDS), pa.array(keys))
                raw = pa.array([r.tobytes() for r in table], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, last - first), batch.column(1).slice(first, last - first), pa.array(size), pa.array(xor.view(np.int64)), pa.array(total.view(np.int64)), raw, bands],
                    ["key", "id", "n", "xor", "sum", "registers", "bands"],
                )

    return docs.mapInArrow(released(run), "key binary, id long, n long, xor long, sum long, registers binary, bands array<long>")


def likely(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose registers do not speak against the similarity."""
    floor = percent / 100 - SLACK
    side = lambda c: nodes.select(F.col("id").alias(c), F.col("n").alias(f"n_{c}"), F.col("registers").alias(f"r_{c}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", "n_a", "n_b", "r_a", "r_b")

    def run(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            view = lambda i: np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint16).reshape(-1, REGISTERS)  # noqa: E731, B023
            near = estimate(view(4), view(5), batch.column(2).to_numpy().astype(float), batch.column(3).to_numpy().astype(float))
            yield batch.select(["a", "b"]).filter(pa.array(near >= floor))

    return both.mapInArrow(released(run), "a long, b long")


def verify(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose full shingle sets are similar enough; b is the pivot.

    A pivot's text meets its members' texts in groups of about GROUP, so it is sent once for a group
    and a pivot with very many members is spread over tasks.
    """
    load = pairs.groupBy("b").agg(F.ceil(F.count(F.lit(1)) / GROUP).cast("int").alias("salts"))
    none = F.lit(None).cast("long")
    member = (
        pairs.join(load, "b").select("b", F.pmod(F.xxhash64("a"), F.col("salts")).cast("int").alias("salt"), "a")
        .join(texts.select(F.col("id").alias("a"), "text"), "a")
        .select("b", "salt", "a", "text")
    )
    pivot = (
        load.select("b", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
        .join(texts.select(F.col("id").alias("b"), "text"), "b")
        .select("b", "salt", none.alias("a"), "text")
    )
    together = pivot.unionByName(member).repartition("b", "salt").sortWithinPartitions("b", "salt", F.col("a").asc_nulls_first())

    def run(batches):
        base = np.zeros(0, np.uint64)
        for batch in batches:
            b, a = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            found = []
            for first, last, data, offsets in chunks(batch.column(3)):
                hashed, at = distinct_shingles(data, offsets)
                for i in range(first, last):
                    own = hashed[at[i - first] : at[i - first + 1]]
                    if a[i] is None:
                        base = own.copy()
                        continue
                    shared = len(np.intersect1d(own, base, assume_unique=True))
                    if shared and 100 * shared >= percent * (len(own) + len(base) - shared):
                        found.append((a[i], b[i]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], ["a", "b"]
            )

    return together.mapInArrow(released(run), "a long, b long")


def _open_buckets(active: DataFrame, labels: DataFrame) -> DataFrame:
    """Members (key, id, n, mass, comp, members, first) of buckets that still hold several components."""
    named = active.join(labels, "id", "left").withColumn("comp", F.coalesce("comp", "id"))
    still = named.groupBy("key").agg(
        F.min("comp").alias("low"), F.max("comp").alias("high"), F.count(F.lit(1)).alias("members"),
        F.max(F.struct("mass", "id")).alias("first"), F.bit_xor(F.xxhash64("id")).alias("xor"), F.sum(F.xxhash64("id").bitwiseAND(F.lit(0xFFFFFFFF))).alias("sum"),
    ).filter("low < high")
    # Bands that gather the same members are one bucket: whole numbers, so the order of rows does not matter.
    one = still.groupBy("members", "low", "high", "first", "xor", "sum").agg(F.min("key").alias("key"))
    return named.join(one.select("key", "members", "first"), "key")


def link(nodes: DataFrame, texts: DataFrame, buckets: DataFrame, percent: int) -> DataFrame:
    """(id, comp) of all nodes (id, n, registers) that ``buckets`` (key, id, n, mass) connect.

    Two rounds compare the members of each bucket that is not connected with its pivots, one and then
    PIVOTS: those of most ``mass``, as the text that a group's copies were made from shares most
    bands with the others and usually connects them all at once. Pivots retire. What then is left
    in a bucket is compared in blocks. So in the end every two members of a bucket are connected,
    were compared, or differ too much in size.
    """
    spark = nodes.sparkSession
    labels = spark.createDataFrame([], "id long, comp long")
    tested = spark.createDataFrame([], "a long, b long")
    active = buckets
    for wanted in (1, PIVOTS):
        central = Window.partitionBy("key").orderBy(F.desc("mass"), "id")
        pivot = (F.col("first.id") == F.col("id")) if wanted == 1 else F.row_number().over(central) <= wanted
        active = stored(
            _open_buckets(active, labels).withColumn("pivot", pivot).drop("first", "members"), "buckets"
        )
        pivots = active.filter("pivot").select("key", F.col("id").alias("b"), F.col("n").alias("n_b"), F.col("comp").alias("comp_b"))
        alike = F.least("n", "n_b") * 100 >= F.greatest("n", "n_b") * percent
        met = (
            active.join(pivots, "key")
            .filter((F.col("comp") != F.col("comp_b")) & alike & (~F.col("pivot") | (F.col("id") < F.col("b"))))
            .select(F.col("id").alias("a"), "b")
            .distinct()
        )
        both_ways = tested.unionByName(tested.select(F.col("b").alias("a"), F.col("a").alias("b")))
        tested = stored(met.join(both_ways, ["a", "b"], "left_anti"), "pairs")
        found = stored(verify(stored(likely(tested, nodes, percent), "likely"), texts, percent), "found")
        labels = _merge(labels, found)
        active = active.filter("NOT pivot").select("key", "id", "n", "mass")
    rest = stored(_open_buckets(active, labels).select("key", "id", "comp", "members"), "buckets")
    if rest.isEmpty():
        return labels
    return _merge(labels, stored(compare_blocks(rest, texts, percent), "found"))


def shared_counts(hashed: np.ndarray, at: np.ndarray) -> np.ndarray:
    """(rows, rows): sizes of the intersections of the sets between the offsets ``at``."""
    n = len(at) - 1
    row = np.repeat(np.arange(n), np.diff(at))
    order = np.argsort(hashed, kind="stable")
    value, row = hashed[order], row[order]
    new = np.append(True, value[1:] != value[:-1])[: len(value)]
    size = np.diff(np.append(np.flatnonzero(new), len(value)))
    several = np.repeat(size > 1, size)  # what one row alone holds is in no intersection
    row, column = row[several], np.cumsum(new[several]) - 1
    total = np.zeros((n, n), np.float32)
    width = max(1, (1 << 22) // max(n, 1))
    last = int(column[-1]) + 1 if len(column) else 0
    for first in range(0, last, width):
        a, b = np.searchsorted(column, [first, first + width])
        part = np.zeros((n, width), np.float32)
        part[row[a:b], column[a:b] - first] = 1
        total += part @ part.T
    return total.astype(np.int64)


def compare_blocks(members: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) among the members (key, id, comp, members) of each bucket, by full sets.

    A bucket of more than GROUP members is cut into blocks by a hash; a task holds two blocks at
    most. Products of the sets' indicator matrices count the intersections, and of the links found a
    task gives back only such as join components, so no pairs are written out.
    """
    blocks = F.ceil(F.col("members") / GROUP).cast("int")
    own = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    units = (
        members.withColumn("blocks", blocks).withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("key", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "id", "comp")
    )
    laid = units.join(texts.select("id", "text"), "id").select("key", "x", "y", "id", "comp", "text")
    laid = laid.repartition("key", "x", "y").sortWithinPartitions("key", "x", "y", "id")

    def links(rows):
        data, offsets = buffers(pa.concat_arrays([r[2] for r in rows]))
        ids, comp = np.concatenate([r[0] for r in rows]), np.concatenate([r[1] for r in rows])
        hashed, at = distinct_shingles(data, offsets)
        shared, size = shared_counts(hashed, at), np.diff(at)
        near = (shared > 0) & (100 * shared >= percent * (size[:, None] + size[None, :] - shared))
        found, top = [], {}

        def root(c):
            while top.get(c, c) != c:
                c = top[c]
            return c

        for i, j in zip(*np.nonzero(np.triu(near, 1)), strict=True):
            a, b = root(comp[i]), root(comp[j])
            if a != b:
                top[max(a, b)] = min(a, b)
                found.append((int(ids[i]), int(ids[j])))
        return pa.RecordBatch.from_arrays([pa.array([f[k] for f in found], pa.int64()) for k in (0, 1)], ["a", "b"])

    def run(batches):
        held, unit = [], None
        for batch in batches:
            if not batch.num_rows:
                continue
            place = np.stack([batch.column(i).to_numpy().astype(np.int64) for i in range(3)], axis=1)
            cut = [0, *(np.flatnonzero((place[1:] != place[:-1]).any(axis=1)) + 1).tolist(), batch.num_rows]
            for a, b in zip(cut[:-1], cut[1:], strict=True):
                if held and tuple(place[a]) != unit:
                    yield links(held)
                    held = []
                unit = tuple(place[a])
                held.append((batch.column(3).to_numpy()[a:b], batch.column(4).to_numpy()[a:b], batch.column(5).slice(a, b - a)))
        if held:
            yield links(held)

    return laid.mapInArrow(released(run), "a long, b long")


def _merge(labels: DataFrame, found: DataFrame) -> DataFrame:
    """Labels after further links: components of components."""
    if found.isEmpty():
        return labels
    of = lambda c: labels.select(F.col("id").alias(c), F.col("comp").alias(f"comp_{c}"))
    raised = (
        found.join(of("a"), "a", "left").join(of("b"), "b", "left")
        .select(F.coalesce("comp_a", "a").alias("a"), F.coalesce("comp_b", "b").alias("b"))
        .filter("a <> b")
    )
    joined = components(raised)
    old = labels.join(joined.select(F.col("id").alias("comp"), F.col("comp").alias("top")), "comp", "left").select(
        "id", F.coalesce("top", "comp").alias("comp")
    )
    new = joined.join(labels.select("id"), "id", "left_anti")
    return stored(old.unionByName(new.select("id", "comp")), "components")


def _key(doc_id: str, text: str) -> Column:
    """What tells rows apart: a hash of the id and the text."""
    name = F.coalesce(quoted(doc_id).cast("long").cast("string"), F.lit("-"))
    return F.unhex(F.md5(F.concat(name, F.lit(" "), whole(text)).cast("binary")))


def _filter(keys: DataFrame) -> Broadcast:
    return bloom.broadcast(keys.select(F.lit(0).alias("shard"), F.xxhash64("key").alias("hash")), FILTER_BYTES)


def _sifted(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows whose key may be among ``keys``: the others' texts are not sent to a join."""
    return rows.filter(bloom.may_hold(F.xxhash64("key"), _filter(keys)))


def _groups(rows: DataFrame, percent: int, by_id: bool) -> tuple[DataFrame, DataFrame]:
    """((key, id, n, node, c) of all distinct rows (key, id, text), (node, comp) of linked nodes).

    Every row is sketched and compared. Rows of equal sets are one ``node``, NULL for those without
    shingles; ``c`` is the number of equal rows. With ``by_id``, rows of one id are linked too.
    """
    sketches = stored(sketch(rows), "sketches")
    counted = stored(sketches.groupBy("key").agg(F.count(F.lit(1)).alias("c")).filter("c > 1"), "repeated")
    repeated = not counted.isEmpty()
    if repeated:  # equal rows have equal sketches
        sketches = stored(sketches.dropDuplicates(["key"]), "sketches")
    same = ["xor", "sum", "n"]
    classes = sketches.filter("n > 0").groupBy(*same).agg(F.min("key").alias("key"))
    classes = stored(classes.withColumn("node", F.monotonically_increasing_id()), "classes")
    members = sketches.select("key", "id", *same).join(classes.select(*same, "node"), same, "left").select("key", "id", "n", "node")
    members = stored(members.join(counted, "key", "left").withColumn("c", F.coalesce("c", F.lit(1))), "members")
    heads = classes.select("key", "node")
    nodes = sketches.join(heads, "key").select(F.col("node").alias("id"), "n", "registers", "bands")
    spread = nodes.select("id", "n", F.explode("bands").alias("key"))
    full = spread.groupBy("key").agg(F.count(F.lit(1)).alias("c")).filter("c > 1")
    shared = stored(spread.join(full, "key"), "buckets")
    mass = shared.groupBy("id").agg(F.sum("c").alias("mass"))
    buckets = shared.join(mass, "id").select("key", "id", "n", "mass")
    wanted = stored(mass.select("id").join(heads.withColumnRenamed("node", "id"), "id"), "candidates")
    some = stored(nodes.select("id", "n", "registers").join(wanted, "id", "left_semi"), "registers")
    texts = _sifted(rows.select("key", "text"), wanted).join(wanted, "key").select("id", "text")
    if repeated:
        texts = texts.groupBy("id").agg(F.min("text").alias("text"))
    labels = link(some, stored(texts, "texts"), buckets, percent)
    if by_id:
        one = members.filter("node IS NOT NULL").groupBy("id").agg(F.min("node").alias("b"), F.max("node").alias("top"))
        ties = one.filter("b < top").select("id", "b")
        if not ties.isEmpty():
            labels = _merge(labels, members.join(ties, "id").filter("node <> b").select(F.col("node").alias("a"), "b"))
    return members, labels.select(F.col("id").alias("node"), "comp")


def near_duplicates(docs: DataFrame, percent: int = PERCENT, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with ``n_shingles``, ``component_id`` and ``kept``.

    Words are what ASCII white space parts, A-Z in lower case; a text of fewer than five words is one
    shingle. Two documents are linked if their sets' intersection is ``percent`` of the union or more;
    ``component_id`` is the smallest id that links reach. NULL and empty texts have no shingles and no
    links. Rows that repeat an id are one document: each text is compared, and the links of any are
    links of the id; ``n_shingles`` is the row's own, ``kept`` the id's. Rows without an id are kept
    and have no results here: their ``n_shingles`` and ``component_id`` are NULL (:func:`keep_one`
    compares them too).
    """
    rows = docs.select(_key(doc_id, text).alias("key"), quoted(doc_id).cast("long").alias("id"), whole(text).alias("text"))
    members, labels = _groups(rows.filter("id IS NOT NULL"), percent, by_id=True)
    named = members.join(labels, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    low = named.filter("comp IS NOT NULL").groupBy("comp").agg(F.min("id").alias("low"))
    named = stored(named.join(low, "comp", "left").select("key", "id", "n", "low"), "named")
    twice = named.groupBy("id").agg(F.count(F.lit(1)).alias("rows"), F.min("low").alias("id_low")).filter("rows > 1")
    if not twice.isEmpty():  # an empty text goes with the others of its id
        named = named.join(twice, "id", "left").withColumn("low", F.coalesce("low", "id_low"))
    found = named.select("key", "n", F.coalesce("low", "id").alias("comp"), "id")
    return packed(docs, key=_key(doc_id, text)).join(found, "key", "left").select(
        *unpacked(docs, "n_shingles", "component_id", "kept"),
        F.col("n").alias("n_shingles"),
        F.col("comp").alias("component_id"),
        F.coalesce(F.col("comp") == F.col("id"), F.lit(True)).alias("kept"),
    )


def keep_one(docs: DataFrame, percent: int = PERCENT, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are left if one row of each group of near duplicates stays.

    Rows are compared by their own texts, whatever their ids, with or without one. The row with the
    smallest id stays, one without an id only if its whole group has none. Of rows equal in id and text
    the least by the other columns stays, also if the text is empty.
    """
    rows = docs.select(_key(doc_id, text).alias("key"), quoted(doc_id).cast("long").alias("id"), whole(text).alias("text"))
    members, labels = _groups(rows, percent, by_id=False)
    named = members.join(labels, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    heads = named.filter("comp IS NOT NULL").groupBy("comp").agg(
        F.min(F.struct(F.col("id").isNull().alias("last"), "id", "key", "c")).alias("head")
    ).select("head.key", "head.c")
    heads = stored(heads.unionByName(named.filter("comp IS NULL").select("key", "c")), "heads")
    # Rows that go and rows with an equal are looked for; all others stay where they are.
    gone = members.select("key").join(heads, "key", "left_anti").withColumn("c", F.lit(0).cast("long"))
    odd = stored(gone.unionByName(heads.filter("c > 1")), "odd")
    columns = [quoted(c) for c in docs.columns]
    named = docs.select(F.struct(*columns).alias("row"), _key(doc_id, text).alias("key"))
    known = _filter(odd)
    clear = named.filter(~bloom.may_hold(F.xxhash64("key"), known)).select("row")
    doubtful = named.filter(bloom.may_hold(F.xxhash64("key"), known)).join(
        odd.select("key", "c"), "key", "left"
    )
    alone = doubtful.filter("c IS NULL").select("row")
    if heads.filter("c > 1").isEmpty():
        return clear.unionByName(alone).select("row.*")
    least = doubtful.filter("c > 1").groupBy("key").agg(F.min("row").alias("row")).select("row")
    return clear.unionByName(alone).unionByName(least).select("row.*")
