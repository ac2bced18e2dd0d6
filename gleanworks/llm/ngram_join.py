"""All pairs of texts whose sets of 5-word shingles have a Jaccard similarity of 0.75 or more.

1. Equal sets are one entity, known by the fingerprint of its sorted hashes.
2. All shingle hashes of all entities are dealt to hash buckets; there, those of two or more
   entities are found. Only they can be common to a pair. They go back to their entity, with the
   number of entities that hold them. Shingles that a share of a sample of entities holds are dealt
   by entity as well, so that no bucket gets all of their holders; they count as shared. Sets are
   dealt in batches, and on the way an entity is its number in its batch: about a byte a shingle,
   whatever the number of buckets. Copies are left out; where one is dealt all the same, its
   shingles count as shared, which costs work and changes no result.
3. An entity of n shingles can link only if at least 0.75 n of them are shared. The rest drop out.
4. Near copies of one text mostly agree in the least hash under some order: each entity is compared
   with the most copied entity of its agreeing group, exactly. That joins large groups by a link each.
   The heads of groups of more than a thousandth of the entities go to all tasks.
5. Every other possible pair shares one of its (shared - 0.75 n + 1) rarest shingles. Entities
   meet in tiles of (size band, such a shingle) unless all of a tile are in one component already;
   large tiles are cut into pairs of blocks by bytes. Tiles are dealt to parts by hash; an entity's
   bitmaps go to a part once, whatever the number of its tiles there. In a tile, hashed bitmaps
   whose width follows the band bound the overlap from above; the pairs that are left are compared
   exactly, by their sorted arrays of shared hashes.

All filters are exact bounds: no pair is lost at any frequency or group size. Hashes have 64 bits
(48 and the bucket's from step 2 on), so sets are compared up to collisions.

Nulls and texts without words: an empty set, linked with nothing. Texts shorter than five words:
one shingle, the whole sequence. Repeated rows: as other copies; a null id takes no part in
the naming of a component. Empty input: an empty result. Extra columns are ignored by near_groups
and kept by one_of_each, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gleanworks.llm.common import durable, joined_bytes, text_groups
from gleanworks.llm.components import components
from gleanworks.llm.shingles import GROUP_BYTES, mixed, set_key, shingle_sets
from gleanworks.session import table

#: Two sets link when PART * |both| >= SHARE * |either|.
SHARE, PART = 75, 100
BUCKET_BYTES, LEAST_BUCKETS = 4_000_000, 48
FLUSH = 1_000_000
#: Of the rows whose set another row stands for, about so many at most are named to all tasks, which leave them out.
COPIES = 1_000_000
#: Bytes of bitmaps in a block of a tile, and in what one task compares at once.
BLOCK_BYTES, PART_BYTES = 500_000, 24_000_000
TILE_ROW = 40
BUCKETS_A_TASK = 4
SEEDS = (0, 0x5851F42D4C957F2D, 0x14057B7EF767814F)
#: Of about SAMPLE entities, drawn by their fingerprints, HELD must hold a shingle for it to be dealt by entity too;
#: the COMMON most held at most. Where work is done depends on them, no result does.
SAMPLE, HELD, COMMON = 4000, 20, 65_536
#: Groups of one least hash beyond this share of the entities are met by a broadcast of their heads, HOT_HEADS a seed at most.
HOT_HEADS = 1000
LOW = np.uint64((1 << 48) - 1)
CODEC = pa.Codec("zstd", 1)


def need(n):
    """The least overlap by which a set of size n can link."""
    return -(-n * SHARE // PART)


def band_edges(top: int = 1 << 40) -> np.ndarray:
    """Lower ends of the size bands; linked sets are in one band or in neighbouring ones."""
    out = [1]
    while out[-1] < top:
        out.append(max(out[-1] + 1, -(-out[-1] * PART // SHARE)))
    return np.array(out)


EDGES = band_edges()


def map_bits(band: int) -> int:
    """About four bits for each shingle of the band's largest set."""
    return 64 << max(0, int(4 * EDGES[band + 1] - 1).bit_length() - 6)


def bitmap(s: np.ndarray, band: int) -> bytes:
    """A bitmap of hashed shingles, of the band's width."""
    width = map_bits(band)
    bits = np.zeros(width, np.uint8)
    bits[(mixed(s) & np.uint64(width - 1)).astype(np.int64)] = 1
    return np.packbits(bits).tobytes()


def _mark():
    """A row's name among rows(doc_id, text_hash)."""
    return F.xxhash64("doc_id", "text_hash").alias("mark")


def folded(maps: np.ndarray, width: int) -> np.ndarray:
    """Rows of bitmaps, at `width` bytes each: what bitmap makes for a narrower band."""
    while maps.shape[1] > width:
        half = maps.shape[1] // 2
        maps = maps[:, :half] | maps[:, half:]
    return maps


def memberships(docs: DataFrame, k: int = 5) -> DataFrame:
    """(doc_id, text_hash, n_shingles, entity) of docs(doc_id, text_hash, text); entity is null for an empty set."""

    def rows(batches):
        for own, texts in text_groups(batches, GROUP_BYTES):
            sets = shingle_sets(texts, k)
            keys = pa.array([set_key(s) if len(s) else None for s in sets], pa.int64())
            sizes = pa.array([len(s) for s in sets], pa.int64())
            yield pa.RecordBatch.from_arrays([own["doc_id"], own["text_hash"], sizes, keys], ["doc_id", "text_hash", "n_shingles", "entity"])

    return docs.mapInArrow(rows, "doc_id long, text_hash long, n_shingles long, entity long")


def _runs(sorted_values: np.ndarray) -> np.ndarray:
    """Starts of the runs of equal values."""
    return np.flatnonzero(np.concatenate([[True], sorted_values[1:] != sorted_values[:-1]])) if len(sorted_values) else np.zeros(0, np.int64)


def _squeezed(v: np.ndarray) -> bytes:
    """Small numbers in the narrowest of 1, 2 or 4 bytes, compressed; the first byte tells the width."""
    width = next(w for w in (1, 2, 4) if not len(v) or v.max() < 1 << 8 * w)
    return bytes([width]) + CODEC.compress(v.astype(f"u{width}").tobytes(), asbytes=True)


def _unsqueezed(column: pa.ChunkedArray, lengths: np.ndarray) -> np.ndarray:
    """The numbers of all rows of a column of _squeezed, in one array."""
    out = [np.frombuffer(CODEC.decompress(b[1:], int(n) * b[0], asbytes=True), f"u{b[0]}") for b, n in zip(column.to_pylist(), lengths)]
    return np.concatenate([x.astype(np.int64) for x in out]) if out else np.zeros(0, np.int64)


def _low_bytes(h: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(h.view(np.uint8).reshape(-1, 8)[:, :6])


def _batched(key: np.ndarray, number: np.ndarray, h: np.ndarray):
    """(start, end, key, gaps of the numbers, low bytes of the hashes) of each run of a key; rows are in order of key, then number."""
    low, ends = _low_bytes(h), np.append(_runs(key), len(key))
    for a, b in zip(ends[:-1], ends[1:]):
        yield a, b, int(key[a]), _squeezed(np.diff(number[a:b], prepend=0)), low[a:b].tobytes()


def _gathered(t: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row of t, entity's number in its batch, low bits of the hash) of each shingle of rows that _batched made."""
    lengths = pc.binary_length(t["data"]).to_numpy().astype(np.int64) // 6
    gaps = _unsqueezed(t["numbers"], lengths)
    total, starts = np.cumsum(gaps), np.cumsum(lengths) - lengths
    number = total - np.repeat(total[starts] - gaps[starts], lengths)
    low = np.zeros((len(gaps), 8), np.uint8)
    low[:, :6] = joined_bytes(t["data"], np.uint8).reshape(-1, 6)
    return np.repeat(np.arange(len(t)), lengths), number, low.view(np.uint64)[:, 0]


def _rows(rows: list[tuple]) -> pa.Table:
    """rows(target, batch, numbers, data, held)."""
    kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
    return pa.table([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], ["target", "batch", "numbers", "data", "held"])


def _holder(batch: np.ndarray | int, number: np.ndarray) -> np.ndarray:
    """What stands for the entity of a number in a batch when its common shingles are dealt."""
    return np.asarray(batch, np.int64).view(np.uint64) + number.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)


def copies(members: DataFrame) -> DataFrame:
    """(mark): of rows whose set a row of a lesser mark has too, about COPIES at most; the rows of an entity of one mark are equal."""
    own = members.where("entity IS NOT NULL").select("entity", _mark()).distinct()
    least = own.groupBy("entity").agg(F.min("mark").alias("least"), F.count("*").alias("rows")).where("rows > 1")
    more = durable(own.join(least, "entity").where("mark <> least").select("mark"))
    n = more.count()
    return more if n <= COPIES else more.where(F.col("mark") < -(1 << 63) + (1 << 64) * COPIES // n)


def common_shingles(docs: DataFrame, members: DataFrame, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, estimated numbers of holders) of the shingles that a share of the entities holds, in order of the low 48 bits.

    A share, not a number: HELD of a sample of SAMPLE entities, so what one task gets of a shingle that
    is not among them stays below about HELD / SAMPLE of the entities."""
    own = members.where("entity IS NOT NULL")
    n = own.agg(F.approx_count_distinct("entity").alias("n")).first()["n"]
    if n > SAMPLE:
        own = own.where(F.col("entity") < -(1 << 63) + (1 << 64) * SAMPLE // n)
    # About SAMPLE rows: entities are fingerprints, so evenly spread.
    drawn = own.select("entity", _mark()).groupBy("entity").agg(F.min("mark").alias("mark")).select("mark")

    def hashes(batches):
        for _, texts in text_groups(batches, GROUP_BYTES):
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(shingle_sets(texts, k)).view(np.int64))], ["h"])

    texts = docs.select("text", _mark()).join(F.broadcast(drawn), "mark").select("text")
    counted = texts.mapInArrow(hashes, "h long").groupBy("h").agg(F.count("*").alias("held")).where(F.col("held") >= HELD)
    rows = counted.orderBy(F.desc("held"), "h").limit(COMMON).collect()
    h = np.array([r["h"] for r in rows], np.int64).view(np.uint64)
    held = np.array([r["held"] * max(n, SAMPLE) // SAMPLE for r in rows], np.int64)
    _, one = np.unique(h & LOW, return_index=True)
    return h[one], np.clip(held[one], 2, 65535).astype(np.uint16)


def _spread(h: np.ndarray, entity: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of a common shingle of an entity."""
    return mixed(h ^ entity.view(np.uint64)) % np.uint64(buckets)


def _place(sorted_values: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(places of values in sorted_values, whether they are there)."""
    if not len(sorted_values):
        return np.zeros(len(values), np.int64), np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(sorted_values, values), len(sorted_values) - 1)
    return at, sorted_values[at] == values


def bucket_of(h: np.ndarray, entity: np.ndarray, common: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of each shingle: by the hash alone, or for common ones (in order of the low bits) by entity too."""
    bucket = ((h >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
    at, hit = _place(common & LOW, h & LOW)
    hit = np.flatnonzero(hit)
    hit = hit[common[at[hit]] == h[hit]]
    bucket[hit] = _spread(h[hit], entity[hit], buckets)
    return bucket.astype(np.int64)


def named_hashes(low: np.ndarray, entity: np.ndarray, common: np.ndarray, bucket: int | np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(a shingle's name, its place among common or -1) from the low bits of what bucket_of put into a bucket."""
    bucket = np.broadcast_to(np.asarray(bucket, np.int64), low.shape)
    at, hit = _place(common & LOW, low)
    hit = np.flatnonzero(hit)
    hit = hit[_spread(common[at[hit]], entity[hit], buckets) == bucket[hit].astype(np.uint64)]
    place = np.full(len(low), -1, np.int64)
    place[hit] = at[hit]
    name = low | ((bucket & 0xFFFF).astype(np.uint64) << np.uint64(48))
    name[hit] = common[place[hit]]
    return name, place


def shared_sets(docs: DataFrame, k: int = 5, common: tuple[np.ndarray, np.ndarray] = (np.zeros(0, np.uint64), np.zeros(0, np.uint16)), skipped: DataFrame | None = None) -> DataFrame:
    """(entity, n, weight, hashes, prefix, firsts, band, map) of the entities of which enough is shared.

    weight: how many entities hold a shingle of the set, on average; large for what others copy.
    common: of common_shingles. Any set of hashes is right; those of it count as shared.
    skipped: of copies; rows of these marks are left out. Without it, and beyond it, an entity may come repeatedly."""
    often, holders = common
    size = docs.agg(F.sum(F.octet_length("text")).alias("b")).first()["b"] or 0
    if skipped is not None:
        docs = docs.select("text", _mark()).join(F.broadcast(skipped), "mark", "left_anti").select("text")
    buckets = max(LEAST_BUCKETS, -(-size // BUCKET_BYTES))

    def deal(batches):
        seen, held, total = set(), [], 0

        def flush():
            h = np.concatenate([s for _, s in held])
            entity, n = np.array([e for e, _ in held], np.int64), np.array([len(s) for _, s in held])
            held.clear()
            # Named by what it holds: the same when a task runs again, and batches of one content are one.
            batch = set_key(entity)
            number = np.repeat(np.arange(len(n), dtype=np.uint32), n)
            target = bucket_of(h, _holder(batch, number), often, buckets)
            order = np.argsort(target, kind="stable")
            rows = [(-1 - batch % buckets, batch, _squeezed(n), entity.tobytes(), None)]
            rows += [(key, batch, numbers, data, None) for _, _, key, numbers, data in _batched(target[order], number[order].astype(np.int64), h[order])]
            return _rows(rows).to_batches()[0]

        for _, texts in text_groups(batches, GROUP_BYTES):
            for s in shingle_sets(texts, k):
                if len(s) and (e := set_key(s)) not in seen:
                    if len(seen) < 1_000_000:  # beyond, copies are only found later
                        seen.add(e)
                    held.append((e, s))
                    total += len(s)
            if total >= FLUSH:
                yield flush()
                total = 0
        if held:
            yield flush()

    def find(t):
        bucket = t["target"][0].as_py()
        if bucket < 0:  # what the numbers in a batch stand for
            return t
        row, number, low = _gathered(t)
        batches, nth = np.unique(t["batch"].to_numpy(), return_inverse=True)
        nth = nth[row]
        h, place = named_hashes(low, _holder(batches[nth], number), often, bucket, buckets)
        who = nth << 32 | number
        order = np.lexsort((who, h))
        h, who, place = h[order], who[order], place[order]
        once = np.concatenate([[True], (h[1:] != h[:-1]) | (who[1:] != who[:-1])])
        h, who, place = h[once], who[once], place[once]
        held = np.diff(np.append(_runs(h), len(h)))
        held = np.minimum(np.repeat(held, held), 65535).astype(np.uint16)
        # Of a common shingle other buckets hold the rest: its number is the estimate, in all of them.
        held[place >= 0] = holders[place[place >= 0]]
        shared = np.flatnonzero(held > 1)
        shared = shared[np.argsort(who[shared], kind="stable")]
        h, who, held = h[shared], who[shared], held[shared]
        return _rows([(bucket, int(batches[key]), numbers, data, _squeezed(held[a:b])) for a, b, key, numbers, data in _batched(who >> 32, who & 0xFFFFFFFF, h)])

    def keep(t):
        target = t["target"].to_numpy()
        names, t = t.filter(pa.array(target < 0)), t.filter(pa.array(target >= 0))
        if not len(names):
            raise ValueError("a task that ran again got its rows in another order; write the input to a table first")
        entities = np.frombuffer(names["data"][0].as_py(), np.int64)
        sizes = _unsqueezed(names["numbers"][:1], [len(entities)])
        row, number, low = _gathered(t)
        h, _ = named_hashes(low, _holder(names["batch"][0].as_py(), number), often, t["target"].to_numpy()[row], buckets)
        held = _unsqueezed(t["held"], np.bincount(row, minlength=len(t)))
        order = np.lexsort((h, held, number))
        number, h, held = number[order], h[order], held[order]
        ends, rows = np.append(_runs(number), len(number)), []
        for a, b in zip(ends[:-1], ends[1:]):
            own, size = h[a:b], int(sizes[number[a]])
            if (spare := len(own) - need(size)) < 0:
                continue
            band = int(np.searchsorted(EDGES, size, side="right")) - 1
            firsts = [int(mixed(own ^ np.uint64(s)).min().view(np.int64)) for s in SEEDS]
            rows.append((int(entities[number[a]]), size, int(held[a:b].sum(dtype=np.int64)) * 1000 // size, np.sort(own).view(np.int64), own[: spare + 1].view(np.int64), firsts, band, bitmap(own, band + 1)))
        long, longs = pa.int64(), pa.list_(pa.int64())
        kinds = [long, long, long, longs, longs, longs, pa.int32(), pa.binary()]
        return pa.table([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], ["entity", "n", "weight", "hashes", "prefix", "firsts", "band", "map"])

    schema = "target long, batch long, numbers binary, data binary, held binary"
    dealt = docs.select("text").mapInArrow(deal, schema)
    # As many partitions as the data asks for: a task's share does not grow with them.
    by = lambda df, key: df.repartition(max(1, buckets // BUCKETS_A_TASK), key).groupBy(key)
    found = by(dealt, "target").applyInArrow(find, schema)
    return by(found, "batch").applyInArrow(keep, "entity long, n long, weight long, hashes array<long>, prefix array<long>, firsts array<long>, band int, map binary")


def linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those of pairs(u, v) that link, by the exact intersection of their sorted arrays."""
    a = sets.select(F.col("entity").alias("u"), F.col("n").alias("n1"), F.col("hashes").alias("h1"))
    b = sets.select(F.col("entity").alias("v"), F.col("n").alias("n2"), F.col("hashes").alias("h2"))

    both = F.size(F.array_intersect("h1", "h2"))
    met = pairs.join(a, "u").join(b, "v").withColumn("both", both)
    return met.where(PART * F.col("both") >= SHARE * (F.col("n1") + F.col("n2") - F.col("both"))).select("u", "v")


def tile_pairs(sets: DataFrame, component: DataFrame) -> DataFrame:
    """(u, v): pairs of different components that share a tile and pass the bounds."""
    known = sets.join(component.withColumnRenamed("node", "entity"), "entity", "left")
    known = known.select("entity", "n", "band", "prefix", F.size("hashes").alias("c"), "map", F.coalesce("component", "entity").alias("component"))
    spots = known.select("entity", "component", F.explode(F.array(F.col("band"), F.col("band") + 1)).alias("tile"), "prefix", F.octet_length("map").cast("long").alias("bytes"))
    spots = spots.select("entity", "component", "tile", F.explode("prefix").alias("h"), "bytes")
    mixed_tiles = (
        spots.groupBy("tile", "h")
        .agg(F.min("component").alias("a"), F.max("component").alias("b"), F.sum(F.col("bytes") + TILE_ROW).alias("bytes"))
        .where("a <> b")
        .select("tile", "h", F.ceil(F.col("bytes") / BLOCK_BYTES).cast("int").alias("blocks"))
    )
    own = F.pmod(F.xxhash64("entity"), F.col("blocks")).cast("int")
    met = spots.join(mixed_tiles, ["tile", "h"]).withColumn("own", own)
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    met = durable(met.select("entity", "tile", "h", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "bytes"))
    # An upper bound: as if an entity's bitmaps went along with each of its tiles.
    total = met.agg(F.sum(F.col("bytes") + TILE_ROW).alias("b")).first()["b"] or 0
    parts = -(-total // PART_BYTES) or 1
    met = met.withColumn("part", F.pmod(F.xxhash64("tile", "h", "i", "j"), F.lit(parts)).cast("int"))
    packed = met.groupBy("part", "entity").agg(F.collect_list(F.struct("tile", "h", "i", "j", "own")).alias("spots"))
    facts = known.select("entity", "n", "c", "band", "component", "map")
    rows = packed.join(facts, "entity").repartition(parts, "part").groupBy("part")
    return rows.applyInArrow(_part_pairs, "u long, v long").distinct()


def _part_pairs(t: pa.Table) -> pa.Table:
    """(u, v) of the tiles of one part, whose rows are its entities with their bitmaps and their spots in tiles."""
    t = t.combine_chunks()
    held = t["spots"].combine_chunks() if isinstance(t["spots"], pa.ChunkedArray) else t["spots"]
    held = held.chunk(0) if isinstance(held, pa.ChunkedArray) else held
    row = np.repeat(np.arange(len(t)), pc.list_value_length(held).to_numpy())
    tile, h, i, j, own = held.flatten().flatten()
    tile, h, i, j, own = (x.to_numpy() for x in (tile, h, i, j, own))
    entity, n, c, comp, band = (t[x].to_numpy() for x in ("entity", "n", "c", "component", "band"))
    maps = t["map"].to_pylist()
    order = np.lexsort((entity[row], j, i, h, tile))
    row, tile, h, i, j, own = (x[order] for x in (row, tile, h, i, j, own))
    new = (tile[1:] != tile[:-1]) | (h[1:] != h[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])
    ends = np.concatenate([[0], np.flatnonzero(new) + 1, [len(row)]])
    us, vs = [], []
    for a, b in zip(ends[:-1], ends[1:]):
        if b - a > 1:
            r = row[a:b]
            bits = _tile_maps(maps, r, band[r], tile[a])
            for u, v in _tile(tile[a], i[a] != j[a], entity[r], n[r], c[r], comp[r], own[a:b], band[r], bits):
                us.append(np.minimum(u, v))
                vs.append(np.maximum(u, v))
    return pa.table([pa.array(np.concatenate(x) if x else [], pa.int64()) for x in (us, vs)], ["u", "v"])


def _tile_maps(maps: list[bytes], rows: np.ndarray, band: np.ndarray, tile: int) -> np.ndarray:
    """The bitmaps of a tile's rows at the tile's width; an entity's own is of the width of the band above its own."""
    out = np.empty((len(rows), map_bits(tile) // 8), np.uint8)
    for at in (np.flatnonzero(band == tile), np.flatnonzero(band != tile)):
        if at.size:
            out[at] = folded(np.frombuffer(b"".join(maps[x] for x in rows[at]), np.uint8).reshape(at.size, -1), out.shape[1])
    return out.view(np.uint64)


def _tile(tile, cut, entity, n, c, comp, own, band, maps):
    """The pairs of one tile that may link: different components, sizes and bitmaps within the bounds."""
    for x in range(len(entity) - 1):
        y = slice(x + 1, None)
        ok = (comp[y] != comp[x]) & ((band[y] == tile) | (band[x] == tile))
        ok &= (PART * np.minimum(n[y], n[x]) >= SHARE * np.maximum(n[y], n[x])) & ((own[y] != own[x]) | (not cut))
        y = np.flatnonzero(ok) + x + 1
        if y.size:
            apart = np.bitwise_count(maps[y] ^ maps[x]).sum(1, dtype=np.int64)
            most = (c[y] + c[x] - apart) // 2
            y = y[PART * most >= SHARE * (n[y] + n[x] - most)]
            if y.size:
                yield np.full(y.size, entity[x]), entity[y]


def stars(sets: DataFrame) -> DataFrame:
    """(u, v): each entity v with the entity u of the greatest weight in each of its groups of one least hash."""
    spots = sets.select("entity", "weight", F.posexplode("firsts").alias("seed", "first"))
    heads = spots.groupBy("seed", "first").agg(F.max(F.struct("weight", "entity"))["entity"].alias("u"), F.count("*").alias("rows"))
    heads = durable(heads.where("rows > 1"))
    limit = sets.count() // HOT_HEADS
    # Fewer than len(SEEDS) * HOT_HEADS rows. Their groups are spread over the join that they need no more.
    hot = heads.where(F.col("rows") > limit).select("seed", "first", F.col("u").alias("known"))
    others = heads.where(F.col("rows") <= limit).select("seed", "first", F.lit(-1).alias("salt"), "u")
    salt = F.when(F.col("known").isNull(), -1).otherwise(F.pmod(F.xxhash64("entity"), F.lit(1 << 16)).cast("int"))
    met = spots.join(F.broadcast(hot), ["seed", "first"], "left").withColumn("salt", salt).join(others, ["seed", "first", "salt"], "left")
    met = met.select(F.coalesce("known", "u").alias("u"), F.col("entity").alias("v"))
    return met.where("u <> v").distinct()


def grouped(docs: DataFrame, k: int = 5) -> DataFrame:
    """(doc_id, text_hash, n_shingles, entity, group, component_id) of docs(doc_id, text_hash, text).

    group: an entity of the component; component_id: its least doc_id; both null for an empty set."""
    members = durable(memberships(docs, k))
    sets = durable(shared_sets(docs, k, common_shingles(docs, members, k), copies(members)))
    first_links = durable(linked(stars(sets), sets))
    more_links = linked(tile_pairs(sets, components(first_links)), sets)
    comps = components(first_links.unionByName(more_links)).withColumnRenamed("node", "entity")
    named = members.where("entity IS NOT NULL").groupBy("entity").agg(F.min("doc_id").alias("least"))
    named = durable(named.join(comps, "entity", "left").withColumn("group", F.coalesce("component", "entity")))
    least = named.groupBy("group").agg(F.min("least").alias("component_id"))
    named = named.join(least, "group").select("entity", "group", "component_id")
    return members.join(named, "entity", "left")


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5) -> DataFrame:
    """(doc_id, n_shingles, component_id): component_id is the least id reachable by links."""
    out = grouped(_keyed(docs, id_col, text_col), k)
    return out.select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one row of each group of near copies: that of the least id, and of those the least text hash.

    Rows are chosen by narrow keys (id, text hash); a null id comes last. Rows without words all
    stay. Of rows that agree in id and text, the one of the least hash of all columns stays."""
    rows = grouped(_keyed(docs, id_col, text_col))
    key = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash")
    kept = rows.where("entity IS NOT NULL").groupBy("group").agg(F.min(key).alias("key")).select("key.doc_id", "key.text_hash")
    mark = lambda doc, text: F.struct(F.coalesce(doc.cast("string"), F.lit("null")), text)
    kept = kept.select(mark(F.col("doc_id"), F.col("text_hash")).alias("_mark"))
    blank = rows.where("entity IS NULL").select(mark(F.col("doc_id"), F.col("text_hash")).alias("_mark"), F.lit(True).alias("_blank")).distinct()
    chosen = kept.withColumn("_blank", F.lit(False)).unionByName(blank)
    # The caller's columns go along in a struct, so that none of their names can clash.
    own = F.struct(*(F.col(f"`{c}`") for c in docs.columns))
    text = F.col(text_col).cast("string")
    held = docs.select(own.alias("_row"), mark(F.col(id_col).cast("long"), F.xxhash64(text)).alias("_mark")).join(chosen, "_mark")
    nth = F.row_number().over(Window.partitionBy("_mark").orderBy(F.xxhash64("_row")))
    return held.withColumn("_nth", nth).where("_blank OR _nth = 1").select("_row.*")


def op3_ngram_join(spark, sf_dir):
    """Groups of near copies among all documents."""
    return near_groups(table(spark, sf_dir, "documents"))
