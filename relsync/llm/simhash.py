"""SimHash near-duplicate groups by meet-in-the-middle ball hashing (operator 8).

A document's fingerprint is the 64-bit SimHash of its word shingles. Two fingerprints are
linked if they differ in at most ``max_bits`` bits. To find all links, every distinct
fingerprint emits all its variants within half of that radius; fingerprints within the
radius meet in at least one common variant, so a shuffle on variants brings them together.
Meetings are deduplicated and verified bit by bit, and documents get the smallest id that
their fingerprint's links reach.

Scale: a task gets fingerprints, not documents; copies of a text, however many, are one
fingerprint. At most as many distinct fingerprints meet in a variant as its ball has points
(65 for half radius 1), so no variant is hot. In a variant all fingerprints are linked to one
of them instead of to each other: it is within the radius of each, so nothing that is
connected falls apart, and the number of pairs stays linear. Components come from a
logarithmic number of rounds of star contraction over the links.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from relsync.llm.common import cut, hash_key, in_batches, tie_break, without

#: Seed of the shingle hash (the SQL function xxhash64 has the same).
SEED = 42
#: Bytes of text that are split into words at a time.
PIECE = 1 << 20


def _words(data: bytes):
    """Lists of the words of a text, a piece at a time."""
    at = 0
    while at < len(data):
        end = at + PIECE
        if end < len(data):
            while end < len(data) and not data[end:end + 1].isspace():
                end += 1
        if words := data[at:end].split():
            yield words
        at = end


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """SimHash of a text: ASCII upper case is lowered, words are split at ASCII white space,
    shingles are runs of ``shingle`` words joined by a space, repeats included (with fewer
    words the whole sequence is the one shingle). A bit is set if over half of the shingles'
    XXH64 values have it set. Null and wordless texts: 0."""
    data = (text or "").encode("utf-8", "surrogatepass").lower()
    ones, n, carry = np.zeros(64, dtype=np.int64), 0, []
    for words in _words(data):
        words = carry + words
        if len(words) >= shingle:
            line = b" ".join(words)
            size = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
            end = np.cumsum(size + 1) - 1
            start = end - size
            spans = zip(start[: len(words) - shingle + 1].tolist(), end[shingle - 1:].tolist(), strict=True)
            h = np.array([xxhash.xxh64_intdigest(line[a:b], SEED) for a, b in spans], dtype="<u8")
            ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
            n += len(h)
        carry = words[max(0, len(words) - shingle + 1):] if shingle > 1 else []
    if n == 0:
        if not carry:
            return 0
        h = np.array([xxhash.xxh64_intdigest(b" ".join(carry), SEED)], dtype="<u8")
        ones, n = np.unpackbits(h.view(np.uint8), bitorder="little").astype(np.int64), 1
    bits = (2 * ones > n).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, *, shingle: int = 3, text_col: str = "text", name: str = "__fp") -> DataFrame:
    """``docs``, all columns kept, with the fingerprint of each text as a signed long ``name``."""
    docs = without(docs, name)
    at = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            text = batch.column(at)
            fps = np.fromiter((fingerprint(t.as_py(), shingle) for t in text), dtype=np.uint64, count=len(text))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(fps.view(np.int64))], names=[*batch.schema.names, name])

    return in_batches(docs, run, T.StructType([*docs.schema.fields, T.StructField(name, T.LongType())]))


def _masks(radius: int) -> list[tuple[int, int]]:
    """(mask, bits) of all 64-bit masks of at most ``radius`` bits, as signed longs."""
    out = []
    for k in range(radius + 1):
        for bits in combinations(range(64), k):
            m = sum(1 << b for b in bits)
            out.append((m - (1 << 64) if m >> 63 else m, k))
    return out


def links(fps: DataFrame, max_bits: int = 2) -> DataFrame:
    """Links (a, b), a > b, between distinct fingerprints (column ``fp``) of ``fps``: each pair
    differs in at most ``max_bits`` bits, and any two fingerprints that do are connected.

    Variants within the greater half of the radius are emitted; those within the smaller half
    are marked as near. Any fingerprint near a variant is within the radius of all that meet
    there, so the smallest near one serves as the hub that the others are linked to.
    """
    far, near = (max_bits + 1) // 2, max_bits // 2
    masks = F.array(*[F.struct(F.lit(m).alias("mask"), F.lit(k <= near).alias("near")) for m, k in _masks(far)])
    variants = fps.select("fp", F.explode(masks).alias("m")).select(
        F.col("fp").bitwiseXOR(F.col("m.mask")).alias("variant"), F.when(F.col("m.near"), F.col("fp")).alias("near"), "fp")
    hub = F.min("near").over(Window.partitionBy("variant"))
    met = variants.withColumn("hub", hub).where("hub <> fp")
    pairs = met.select(F.greatest("fp", "hub").alias("a"), F.least("fp", "hub").alias("b")).distinct()
    return pairs.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= max_bits)


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): root is the smallest node it reaches.

    Alternating star contraction: in a large-star round every node hands its larger
    neighbours to its smallest one, in a small-star round its smaller ones. Rounds end when
    the edges are stars, which is told by their number and sum staying the same. Every round
    is written to the shared checkpoint folder.
    """
    def star(e, large):
        both = e.unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # nodes' neighbours, themselves included; small stars look at the smaller ones only
        view = both if large else e
        low = view.groupBy("a").agg(F.min("b").alias("low")).select("a", F.least("a", "low").alias("low"))
        moved = view.join(low, "a")
        if large:
            new = moved.where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b"))
        else:
            new = moved.select(F.col("b").alias("a"), F.col("low").alias("b")).unionByName(low.select("a", F.col("low").alias("b")))
        return new.where("a <> b").distinct()

    def sign(e):
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    edges = cut(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct())
    seen = sign(edges)
    for _ in range(max_rounds):
        if not seen[0]:
            break
        edges = cut(star(star(edges, True), False))
        now = sign(edges)
        if now == seen:
            break
        seen = now
    else:
        raise RuntimeError(f"no fixed point after {max_rounds} rounds")
    nodes = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    return nodes.unionByName(edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


def groups(narrow: DataFrame, max_bits: int, id_col: str) -> DataFrame:
    """(fp, root, component_id): one row per distinct fingerprint of ``narrow`` (id, __fp)."""
    own = cut(narrow.groupBy(F.col("__fp").alias("fp")).agg(F.min(id_col).alias("own")))
    roots = components(links(own, max_bits))
    of = own.join(roots, own["fp"] == roots["node"], "left").select("fp", F.coalesce("root", "fp").alias("root"), "own")
    # only fingerprints with links need another look; the others' smallest id is their own
    smallest = of.groupBy("root").agg(F.min("own").alias("component_id"))
    return of.join(smallest, "root").select("fp", "root", "component_id")


def near_duplicates(
    docs: DataFrame, *, shingle: int = 3, max_bits: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per row of ``docs``: id, ``fingerprint`` (16 lowercase hex digits) and
    ``component_id``, the smallest id that links reach, the row itself included.

    Null and wordless texts have fingerprint 0 and are linked like any other. Rows with a null
    id take part; a component of null ids only has a null component_id. Repeated rows are
    linked to each other and all returned. An empty table gives an empty result; columns
    other than the two named play no part.
    """
    narrow = cut(fingerprints(docs.select(id_col, text_col), shingle=shingle, text_col=text_col).select(id_col, "__fp"))
    of = groups(narrow, max_bits, id_col)
    out = narrow.join(of, narrow["__fp"] == of["fp"])
    return out.select(id_col, F.lower(F.lpad(F.hex("__fp"), 16, "0")).alias("fingerprint"), "component_id")


def deduplicate(
    docs: DataFrame, *, shingle: int = 3, max_bits: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs``, all columns, with one row of each near-duplicate group: a row of the smallest id
    (of several rows with that id and equal texts the first by the other columns, of several
    texts the one whose digest is smallest; the id is null only where the whole group has null
    ids).

    Fingerprints are computed once, on narrow rows; the decision comes back to the full rows
    by a digest of id and text. Rows equal in both are reduced to one before they are
    shuffled, so repeated rows make no hot key.
    """
    docs = without(docs, "__key", "__rank")
    key = F.md5(F.concat_ws("|", hash_key(F.col(id_col)), F.coalesce(F.md5(F.col(text_col).cast("binary")), F.lit(""))).cast("binary"))
    narrow = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), key.alias("key"))
    narrow = cut(fingerprints(narrow, shingle=shingle).select("id", "key", "__fp"))
    of = groups(narrow, max_bits, "id")
    rows = narrow.join(of, narrow["__fp"] == of["fp"]).where("id <=> component_id")
    keep = rows.groupBy("root").agg(F.min("key").alias("__keep")).select("__keep")
    first = F.row_number().over(Window.partitionBy("__key").orderBy(*tie_break(docs, id_col)))
    once = docs.withColumn("__key", key).withColumn("__rank", first).where("__rank = 1")
    return once.join(keep, F.col("__key") == F.col("__keep"), "left_semi").select(*[F.col(f"`{c}`") for c in docs.columns])
