"""Removal of byte strings that occur more than once, by suffix arrays of shards that hold all candidates.

A byte goes if a string of ``length`` bytes over it also starts elsewhere. Four steps find them.

Anchors. In every window of ``length`` bytes the ``GRAM`` bytes of the smallest hash mark an anchor; the choice
depends on the window alone, so equal strings have the same anchor at the same offset. Only anchors found at
two places matter. Around each, a segment takes in every string that has this anchor.

Segments. Equal segments at two places need no further look: all their strings repeat. Different segments of an
anchor can share a string only if they share half of what it has beside the gram, on one side; those that do go
to a shard, where each distinct segment stands once.

Suffix arrays. A shard sorts the suffixes of its segments, some anchors' at a time, by Larsson-Sadakane refinement:
groups of suffixes equal in their first h bytes are sorted by the groups at distance h, which doubles h; suffixes alone
in their group are done. A symbol is the hash of ``GRAM`` bytes, as any order of symbols brings equal strings together.
Kasai's rule gives the common prefixes of neighbours; a run of neighbours that share ``length`` bytes is one string at
several places.

Merging. An anchor with more segments than a shard takes is split over shards. Each of these hands on its distinct
strings, once, as sorted 128-bit fingerprints; a merging task finds by binary search those of several shards.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vaultwatch.llm.common import U64, give_back, hash_spans, hash_table, lean, mix, pieces, settle, text_bytes, word_spans

LENGTH = 400
GRAM = 128
SHARD = 2048  # distinct segments to a shard, of less than twice ``length`` bytes each
BATCH = 1 << 20  # bytes of whole anchors that a shard sorts at a time
STEP = 16  # a shard drops segments that have not all but so many bytes of a string in common with another
FILTER_BITS = 23
WORD = 8  # bytes of a word's hash
_EMPTY_SHA = hashlib.sha256(b"").hexdigest()


def anchors(keys: np.ndarray, length: int, gram: int, valid: np.ndarray | None = None) -> np.ndarray:
    """Places of the smallest hash, the last of equal ones, in each window of ``length - gram + 1`` hashes, or in each
    ``valid`` one."""
    width, n = length - gram + 1, len(keys)
    bits = U64(int(n).bit_length())
    low = (U64(1) << bits) - U64(1)
    rows = -(-n // width)
    table = np.full(rows * width, U64(2**64 - 1))
    np.bitwise_and(keys, ~low, out=table[:n])
    table[:n] |= low - np.arange(n, dtype=U64)
    table = table.reshape(rows, width)
    ahead = np.minimum.accumulate(table, axis=1).ravel()
    back = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    least = np.minimum(back[: n - width + 1], ahead[width - 1 : n])
    if valid is not None:
        least = least[valid]
    found = least[np.append(True, least[1:] != least[:-1])] if len(least) else least
    return (low - (found & low)).astype(np.int64)


def _digest(text: bytes) -> bytes:
    return hashlib.blake2b(text, digest_size=16).digest()


def _scan(docs: DataFrame, length: int, gram: int) -> DataFrame:
    """Per row: key, digest, n_bytes, sha256 of the text, and of each distinct segment its anchor's fingerprint, its
    hash, the end of its first place, the anchor's offset, the hashes of the gram with half of ``length - gram`` bytes
    more to either side, and where it begins: a line that stands many times in a text makes one row, not many."""

    half = (length - gram) // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                raw, at = text_bytes(part.column("text"))
                whole, (sums, down) = raw.tobytes(), hash_table(raw)
                texts = [whole[start:end] for start, end in zip(at[:-1].tolist(), at[1:].tolist())]
                digests, shas = [_digest(text) for text in texts], [hashlib.sha256(text).hexdigest() for text in texts]
                grams = mix((sums[gram:] - sums[:-gram]) * down[: max(0, len(raw) - gram + 1)])
                long = np.diff(at) >= length
                edge = np.zeros(len(raw) + 1, np.int8)  # of the windows within a text
                edge[at[:-1][long]], edge[at[1:][long] - length + 1] = 1, -1
                spot = anchors(grams, length, gram, np.cumsum(edge[: len(raw) - length + 1], dtype=np.int8) > 0) if long.any() else np.empty(0, np.int64)
                owner = np.searchsorted(at, spot, "right") - 1
                head, tail = at[owner], at[owner + 1]

                def side(a: np.ndarray) -> np.ndarray:
                    """Hash of the gram and half of what a string has beside it, from here on; 0 beyond the text."""
                    fits = (a >= head) & (a + gram + half <= tail)
                    a = np.where(fits, a, 0)
                    b = np.where(fits, a + gram + half, 0)
                    return np.where(fits, mix((sums[b] - sums[a]) * down[a]), U64(0)).view(np.int64)

                begin, stop = np.maximum(spot - (length - gram), head), np.minimum(spot + length, tail)
                segment = mix((sums[stop] - sums[begin]) * down[begin]) ^ mix((spot - begin).astype(U64) << U64(32) | (stop - begin).astype(U64))
                mark, segment, others = grams[spot].view(np.int64), segment.view(np.int64), (stop - head, spot - begin, side(spot - half), side(spot))
                begin = begin - head
                order = np.lexsort([mark, segment, owner])  # stable: the places of a segment rise
                first = np.append(True, (np.diff(owner[order]) != 0) | (np.diff(segment[order]) != 0) | (np.diff(mark[order]) != 0))[: len(order)]
                told, ends = order[first], np.append(np.flatnonzero(first), len(order))
                begins = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(begin[order]))
                ends = pa.array(np.append(0, np.cumsum(np.bincount(owner[told], minlength=len(texts)))), pa.int32())
                lists = [pa.ListArray.from_arrays(ends, values) for values in (*(pa.array(c[told]) for c in (mark, segment, *others)), begins)]
                yield pa.record_batch([part.column("key"), pa.array(digests, pa.binary()), pa.array(np.diff(at)), pa.array(shas, pa.string()), *lists], names=["key", "digest", "n_bytes", "sha", "mark", "segment", "stop", "spot", "left", "right", "begins"])

    kind = dict(docs.dtypes)["key"]
    return docs.mapInArrow(lean(run), f"key {kind}, digest binary, n_bytes long, sha string, mark array<long>, segment array<long>, stop array<long>, spot array<long>, left array<long>, right array<long>, begins array<array<long>>")


def _filter_of(keys: DataFrame) -> np.ndarray:
    """A bit table of fixed size with a bit for each digest: what has none is surely not among them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(1 << FILTER_BITS >> 3, np.uint8)
        for batch in batches:
            for digest in batch.column("digest").to_pylist():
                at = int.from_bytes(digest[:4], "little") >> (32 - FILTER_BITS)
                bits[at >> 3] |= 1 << (at & 7)
        used = np.flatnonzero(bits)
        yield pa.record_batch({"at": pa.array(used), "bits": pa.array(bits[used].astype(np.int32))})

    found = keys.select("digest").mapInArrow(lean(run), "at long, bits int").groupBy("at").agg(F.bit_or("bits").alias("bits")).toArrow()
    table = np.zeros(1 << FILTER_BITS >> 3, np.uint8)
    table[found["at"].to_numpy()] = found["bits"].to_numpy()
    return table


def _texts(docs: DataFrame, keys: DataFrame) -> DataFrame:
    """digest and text of the rows whose digest is surely or possibly among the keys; a join decides."""
    table = _filter_of(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                raw, at = text_bytes(part.column("text"))
                whole = raw.tobytes()
                rows = []
                for start, end in zip(at[:-1].tolist(), at[1:].tolist()):
                    digest = _digest(whole[start:end])
                    bit = int.from_bytes(digest[:4], "little") >> (32 - FILTER_BITS)
                    if table[bit >> 3] >> (bit & 7) & 1:
                        rows.append((digest, whole[start:end]))
                if rows:
                    yield pa.record_batch([pa.array(c, pa.binary()) for c in zip(*rows)], names=["digest", "text"])

    return docs.select("text").mapInArrow(lean(run), "digest binary, text binary")


def _sorted_places(keys: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The places of the keys in rising order, and the keys in that order.

    Key and place are sorted as one number, which takes half the time of an ``argsort``: the key's ``bits`` if there is
    room for both, else its leading ones; where different keys share these, an ``argsort`` decides.
    """
    n = len(keys)
    width = n.bit_length()
    low = (U64(1) << U64(width)) - U64(1)
    if bits + width <= 64:
        packed = np.sort(keys << U64(width) | np.arange(n, dtype=U64))
        return (packed & low).astype(np.int64), packed >> U64(width)
    cut = U64(max(0, bits + width - 64))
    packed = np.sort(keys >> cut << U64(width) | np.arange(n, dtype=U64))
    place = (packed & low).astype(np.int64)
    found, packed = keys[place], packed >> U64(width)
    if ((packed[1:] == packed[:-1]) & (found[1:] != found[:-1])).any():
        place = np.argsort(keys)
        found = keys[place]
    return place, found


def suffix_array(raw: np.ndarray, ends: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """The order of all suffixes with ``length`` bytes left in their segment, their groups, and the depths refined.

    ``ends``: the end of the segment of each place. The symbols are the hashes of ``gram`` bytes, in the order of
    the hashes. Suffixes equal in their first ``length`` bytes make one group; groups are numbered in their order.
    """
    n, h, depths = len(raw), gram, [gram]
    sums, down = hash_table(raw)
    valid = np.flatnonzero(np.arange(n, dtype=np.int32) + np.int32(h) <= ends).astype(np.int32)
    rank = mix((sums[h:] - sums[:-h]) * down[: max(0, n - h + 1)])[valid] if len(valid) else np.empty(0, U64)
    place, rank = _sorted_places(rank, 64)
    order = valid[place]
    new = np.append(True, rank[1:] != rank[:-1]) if len(order) else np.empty(0, bool)
    group, bits = np.zeros(n, np.int32), len(order).bit_length()
    while len(order):
        # A group's number is the place of its first suffix, so later splits keep the order.
        group[order] = np.maximum.accumulate(np.where(new, np.arange(len(order), dtype=np.int32), 0))
        if h >= length:
            break
        step = min(h, length - h)
        order = order[order + h + step <= ends[order]]
        h += step
        depths.append(h)
        if not len(order):
            break
        mine = group[order]
        new = np.append(True, mine[1:] != mine[:-1])
        at = np.flatnonzero(~(new & np.append(new[1:], True)))  # suffixes alone in their group are done
        if len(at):
            chosen = order[at]
            place, key = _sorted_places(mine[at].astype(U64) << U64(bits) | group[chosen + step].astype(U64), 2 * bits)
            order[at] = chosen[place]
            new[at] = np.append(True, key[1:] != key[:-1])
    return order, group, depths


def common_prefixes(raw: np.ndarray, order: np.ndarray, length: int, depths: list[int]) -> np.ndarray:
    """Common bytes of each suffix and the one before it in the order, up to ``length``, by Kasai's rule.

    Where a place's forerunner is what follows the forerunner of the place before, the common prefix is that of the
    place before less one, unless it is all of ``length`` bytes, which one hash tells. So only the heads of such runs
    compare bytes, and places where a run has come to no common byte. All heads do so at once: their first eight
    bytes, then hashes up to the depths the order was refined to, then half of what is open, then eight bytes again.
    """
    n = len(raw)
    before = np.full(n, -1, np.int32)
    before[order[1:]] = order[:-1]
    known = np.zeros(n, np.int32)
    if not len(order):
        return known[order]
    sums, down = hash_table(raw)
    eight = np.ndarray((n,), ">u8", np.append(raw, np.zeros(8, np.uint8)), strides=(1,))
    held = np.zeros(n, bool)
    held[order] = True
    places = np.flatnonzero(held).astype(np.int32)
    other = before[places]
    whole = (sums[length:] - sums[:-length]) * down[: n - length + 1]
    alike = (other >= 0) & (whole[places] == whole[other])
    del whole, held, before
    follows = np.append(False, (places[1:] - places[:-1] == 1) & (other[1:] - other[:-1] == 1))
    found = np.where(alike, np.int32(length), np.int32(0))
    open_ = ~alike & (other >= 0)
    heads, told = np.flatnonzero(open_ & ~follows), np.flatnonzero(open_ & follows)
    index = np.arange(len(places), dtype=np.int32)
    while len(heads) or len(told):
        found[heads] = _apart(sums, down, eight, places[heads], other[heads], length, depths)
        source = index.copy()
        source[told] = 0
        source = np.maximum.accumulate(source)[told]
        left = found[source] - (told - source)
        found[told] = np.maximum(left, 0)
        heads, told = told[left == -1], told[left < -1]
    known[places] = found
    return known[order]


def _apart(sums: np.ndarray, down: np.ndarray, eight: np.ndarray, x: np.ndarray, y: np.ndarray, length: int, depths: list[int]) -> np.ndarray:
    """How many bytes, less than ``length``, are common to the strings at each pair of places."""
    differ = (eight[x] ^ eight[y]).astype(U64)
    found = np.zeros(len(x), np.int32)
    rest = np.flatnonzero(differ == 0)
    if len(rest) and length > 8:
        x, y = x[rest], y[rest]
        low, high = np.full(len(rest), 8, np.int32), np.full(len(rest), length, np.int32)
        sx, sy, dx, dy = sums[x], sums[y], down[x], down[y]

        def probe(at: np.ndarray) -> None:
            same = (sums[x + at] - sx) * dx == (sums[y + at] - sy) * dy
            np.copyto(low, at, where=same)
            np.copyto(high, at, where=~same)

        for depth in depths:
            if 8 < depth < length:
                probe(np.clip(depth, low, high - 1))
        while (high - low > 8).any():
            probe((low + high) // 2)
        differ[rest], found[rest] = eight[x + low] ^ eight[y + low], low
    for i in range(8):  # equal bytes at the head of the first words that differ
        found += (differ >> U64(56 - 8 * i)) == 0
    return np.minimum(found, length)


def _spans(starts: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of what strings at these rising starts cover."""
    if not len(starts):
        return starts, starts
    new = np.append(True, np.diff(starts) > length)
    return starts[new], starts[np.append(new[1:], True)] + length


def _partnered(table: pa.Table, raw: np.ndarray, begins: np.ndarray, length: int, gram: int) -> np.ndarray:
    """The segments that may share a string with another of their anchor.

    A string around the gram holds one of a few windows of ``length - STEP`` bytes or a little less, at fixed places
    from the gram on; so two segments with a common string have a common window.
    """
    sums, down = hash_table(raw)
    marks, spots = table.column("mark").to_numpy().view(U64), table.column("spot").to_numpy()
    sizes = np.diff(np.append(begins, len(raw)))
    spare = length - gram
    step = min(STEP, spare)
    kept = table.column("several").to_numpy(zero_copy_only=False) & False
    for before in range(0, spare, step):
        width = gram + max(0, spare - before - step) + before
        first = spots - before
        fits = (first >= 0) & (first + width <= sizes)
        at = begins[fits] + first[fits]
        window = mix((sums[at + width] - sums[at]) * down[at]) ^ mix(marks[fits])
        _, which, times = np.unique(window, return_inverse=True, return_counts=True)
        kept[np.flatnonzero(fits)[times[which] > 1]] = True
    return kept


def _by_anchor(table: pa.Table) -> Iterator[pa.Table]:
    """The table in runs of whole anchors, of about ``BATCH`` bytes: equal strings have the same anchor."""
    table = table.sort_by("mark").combine_chunks()
    sizes, marks = pc.binary_length(table.column("bytes")).to_numpy().astype(np.int64), table.column("mark").to_numpy()
    heads = np.flatnonzero(np.append(True, marks[1:] != marks[:-1]))
    run = (np.cumsum(sizes) - sizes)[heads] // BATCH
    cuts_at = heads[np.append(True, run[1:] != run[:-1])]
    for a, b in zip(cuts_at, [*cuts_at[1:], len(marks)]):
        yield table.slice(a, b - a)


def _shard(table: pa.Table, length: int, gram: int, groups: int) -> pa.Table:
    """The repeated spans of a shard's segments, and, of split anchors, each distinct string once."""
    several = table.column("several")
    spans = [(m, s, [0], [e - b]) for m, s, b, e in zip(*(table.filter(several).column(c).to_pylist() for c in ("mark", "segment", "begin", "stop")))]
    packed = []
    for part in _by_anchor(table):
        found, strings = _repeated(part, length, gram)
        spans += found
        where = (strings["code"] % U64(groups)).astype(np.int64)
        packed += [(int(g), strings[where == g].tobytes()) for g in np.unique(where)]
    return _rows(spans, packed)


def _repeated(table: pa.Table, length: int, gram: int) -> tuple[list[tuple], np.ndarray]:
    """Of some whole anchors of a shard: spans of the segments that stand once, and strings of split anchors.

    A string counts once for each place of the corpus; a segment at several places makes all of its strings
    repeat. Two segments may overlap in one text, so places are told apart by text and offset.
    """
    several, split = (table.column(c).to_numpy(zero_copy_only=False) for c in ("several", "split"))
    spans: list[tuple] = []
    sizes = pc.binary_length(table.column("bytes")).to_numpy().astype(np.int64)
    raw = np.frombuffer(b"".join(table.column("bytes").to_pylist()), np.uint8)
    kept = _partnered(table, raw, np.cumsum(sizes) - sizes, length, gram) | split
    table, several, split, sizes = table.filter(pa.array(kept)), several[kept], split[kept], sizes[kept]
    if not kept.any():
        return spans, np.empty(0, _STRING)
    raw = np.frombuffer(b"".join(table.column("bytes").to_pylist()), np.uint8)
    stops = np.cumsum(sizes)
    starts, ends, owner = stops - sizes, np.repeat(stops.astype(np.int32), sizes), np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
    order, _, depths = suffix_array(raw, ends, length, gram)
    new = common_prefixes(raw, order, length, depths) < length
    new[0] = True
    run, spot = np.cumsum(new) - 1, owner[order]
    source = np.unique(np.array(table.column("digest").to_pylist(), object), return_inverse=True)[1]
    place = table.column("begin").to_numpy()[spot] + order - starts[spot]
    known, heads = place * len(sizes) + source[spot], np.flatnonzero(new)
    low, high = np.minimum.reduceat(known, heads), np.maximum.reduceat(known, heads)
    repeats = ((low != high) | np.logical_or.reduceat(several[spot], heads))[run]
    marks, segments = table.column("mark").to_numpy(), table.column("segment").to_numpy()
    hit = np.sort(order[repeats & ~several[spot]])
    if len(hit):
        mine = owner[hit]
        new = np.append(True, (np.diff(hit) > length) | (mine[1:] != mine[:-1]))
        mine, first, last = mine[new], hit[new], hit[np.append(new[1:], True)] + length
        cuts_at = np.flatnonzero(np.append(True, mine[1:] != mine[:-1]))
        a, b = first - starts[mine], last - starts[mine]
        for i, low, high in zip(mine[cuts_at], cuts_at, [*cuts_at[1:], len(mine)]):
            spans.append((marks[i], segments[i], a[low:high].tolist(), b[low:high].tolist()))
    # Of a split anchor: from each run of equal strings the first of these segments if it repeats, else all.
    told = np.flatnonzero(split[spot]) if split.any() else np.empty(0, np.int64)
    if not len(told):
        return spans, np.empty(0, _STRING)
    told = told[np.append(True, run[told[1:]] != run[told[:-1]]) | ~repeats[told]]
    at = order[told]
    strings = np.empty(len(told), _STRING)
    strings["code"], strings["more"] = (hash_spans(values, at, at + length, None) for values in (raw, raw ^ np.uint8(0x5A)))
    strings["mark"], strings["segment"], strings["first"] = marks[spot[told]], segments[spot[told]], at - starts[spot[told]]
    strings["text"] = np.frombuffer(b"".join(table.column("digest").to_pylist()), "V16")[spot[told]]
    strings["place"], strings["repeats"] = place[told], repeats[told]
    return spans, strings


# A string of a split anchor: two hashes of it, its segment and place there, and its place in the corpus.
_STRING = np.dtype([("code", "<u8"), ("more", "<u8"), ("mark", "<i8"), ("segment", "<i8"), ("first", "<i4"), ("text", "V16"), ("place", "<i8"), ("repeats", "?")])
_SPANS = "mark long, segment long, starts array<int>, stops array<int>"
_NAMES = ["mark", "segment", "starts", "stops", "part", "strings"]


def _rows(spans: list[tuple], packed: list[tuple] = ()) -> pa.Table:
    """A row for each segment's spans, and one for the strings that go to each merging task, packed."""
    kinds = [pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.int32(), pa.binary()]
    rows = [(*s, None, None) for s in spans] + [(None, None, None, None, *p) for p in packed]
    return pa.table([pa.array([r[i] for r in rows], kind) for i, kind in enumerate(kinds)], names=_NAMES)


def _merge(strings: DataFrame, length: int) -> DataFrame:
    """Strings that several shards of a split anchor hold, as spans of their segments."""

    def run(table: pa.Table) -> pa.Table:
        rows = np.concatenate([np.frombuffer(s, _STRING) for s in table.column("strings").to_pylist()])
        # Binary search for each string's first and last equal among those of all shards.
        rows = rows[np.argsort(rows["code"])]
        low, high = (np.searchsorted(rows["code"], rows["code"], side) for side in ("left", "right"))
        equal = rows["more"] == rows["more"][low]
        other = equal & ((rows["text"] != rows["text"][low]) | (rows["place"] != rows["place"][low]))
        heads, run_of = np.unique(low, return_inverse=True)
        found = (high - low > 1) & equal & np.logical_or.reduceat(other | rows["repeats"], heads)[run_of] if len(rows) else other
        rows = rows[found]
        rows = rows[np.lexsort([rows["first"], rows["segment"], rows["mark"]])]
        new = np.flatnonzero(np.append(True, (rows["mark"][1:] != rows["mark"][:-1]) | (rows["segment"][1:] != rows["segment"][:-1]))) if len(rows) else []
        spans = []
        for a, b in zip(new, [*new[1:], len(rows)]):
            begin, stop = _spans(np.unique(rows["first"][a:b]).astype(np.int64), length)
            spans.append((rows["mark"][a], rows["segment"][a], begin.tolist(), stop.tolist()))
        return _rows(spans).select(_NAMES[:4])

    return strings.groupBy("part").applyInArrow(run, _SPANS)


def cuts(docs: DataFrame, scanned: DataFrame, length: int, gram: int) -> DataFrame:
    """Per digest of a text that stands once: ``spans``, what repeats of it as (begins, starts, stops)."""
    spots = scanned.select("digest", F.inline(F.arrays_zip("mark", "segment", "stop", "spot", "left", "right", "begins")))
    times = F.sum(F.size("begins"))
    # Settled counts let adaptive execution split the rows of a frequent anchor, as a join right above an aggregate can't.
    marks = settle(spots.groupBy("mark").agg(times.alias("n")).filter("n > 1").drop("n"), "cut-marks")
    spots = settle(spots.join(marks.hint("merge"), "mark"), "cut-spots")
    grouped = spots.groupBy("mark", "segment", "left", "right").agg((times > 1).alias("several"), F.min(F.struct("digest", F.col("begins")[0].alias("begin"), "stop", "spot")).alias("at"))
    grouped = settle(grouped.select("mark", "segment", "left", "right", "several", "at.*"), "cut-segments")
    # A string is longer than its gram by so much that half of it stands on one side: equal strings of different
    # segments have that side in common.
    for side in ("left", "right"):
        sides = grouped.filter(F.col(side) != 0).groupBy("mark", side).agg(F.count("*").alias("n")).filter("n > 1")
        grouped = grouped.join(sides.select("mark", side, F.lit(True).alias(f"{side}_shared")), ["mark", side], "left")
    mixed = F.coalesce("left_shared", F.lit(False)) | F.coalesce("right_shared", F.lit(False))
    grouped = settle(grouped.withColumn("mixed", mixed).filter("mixed OR several").drop("left_shared", "right_shared"), "cut-candidates")
    alike = grouped.filter("several AND NOT mixed").select(
        "mark", "segment", F.array(F.lit(0)).alias("starts"), F.array((F.col("stop") - F.col("begin")).cast("int")).alias("stops")
    )
    mixed = grouped.filter("mixed")
    shards = max(1, mixed.count() * 2 // SHARD)
    # An anchor of too many segments goes by what they share to the left, and once more by what they share to the right.
    sizes = settle(mixed.groupBy("mark").agg(F.count("*").alias("n")), "cut-sizes")
    sized = mixed.join(sizes.hint("merge"), "mark")
    keyed = sized.filter(F.col("n") <= SHARD).withColumn("key", F.xxhash64("mark")).unionByName(
        sized.filter(F.col("n") > SHARD)
        .withColumn("side", F.explode(F.array(F.struct(F.lit("left").alias("name"), F.col("left").alias("h")), F.struct(F.lit("right").alias("name"), F.col("right").alias("h")))))
        .filter("side.h <> 0").withColumn("key", F.xxhash64("mark", "side.name", "side.h")).drop("side")
    ).drop("n")
    keyed = settle(keyed, "cut-keyed")
    split = F.col("n") > SHARD
    shard = F.when(split, F.pmod("segment", F.ceil(F.col("n") / SHARD))).otherwise(F.pmod("key", F.lit(shards)))
    crowds = keyed.groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    dealt = keyed.join(crowds, "key").withColumns({"split": split, "shard": shard, "hot": F.when(split, F.col("key"))})
    # A merging task for each half of a million strings that begin in segments of split anchors.
    groups = max(1, dealt.filter("split").count() * (length - gram) // (1 << 19))
    texts = _texts(docs, mixed).dropDuplicates(["digest"])
    held = dealt.join(texts, "digest").select(
        "mark", "segment", "digest", "begin", "stop", "spot", "several", "split", "shard", "hot", F.expr("substring(text, int(begin) + 1, int(stop - begin))").alias("bytes")
    )

    def run(table: pa.Table) -> pa.Table:
        found = _shard(table, length, gram, groups)
        give_back()
        return found

    sorted_out = settle(held.groupBy("hot", "shard").applyInArrow(run, f"{_SPANS}, part int, strings binary"), "cut-shards")
    spans = alike.unionByName(sorted_out.filter("starts IS NOT NULL").select(alike.columns))
    spans = spans.unionByName(_merge(sorted_out.filter("strings IS NOT NULL").select("part", "strings"), length))
    # A segment of a split anchor has spans from several shards and merging tasks: one row of them meets its places,
    # settled, so that adaptive execution can split the rows of a segment of many texts.
    listed = F.collect_list(F.struct("starts", "stops"))
    spans = settle(spans.groupBy("mark", "segment").agg(*(F.flatten(listed.getField(c)).alias(c) for c in ("starts", "stops"))), "cut-lists")
    placed = spots.select("digest", "mark", "segment", "begins").join(spans.hint("merge"), ["mark", "segment"])
    return placed.groupBy("digest").agg(F.collect_list(F.struct("begins", "starts", "stops")).alias("spans"))


def _covered(size: int, spans: list[dict]) -> list[tuple[int, int]]:
    """The maximal runs that the spans cover."""
    marks = np.zeros(size + 1, np.int64)
    for s in spans:
        begins = np.array(s["begins"], np.int64)  # each once
        for a, b in zip(s["starts"], s["stops"]):
            marks[begins + a] += 1
            marks[begins + b] -= 1
    inside = np.cumsum(marks)[:-1] > 0
    edge = np.diff(np.concatenate([[0], inside.astype(np.int8), [0]]))
    return list(zip(np.flatnonzero(edge > 0).tolist(), np.flatnonzero(edge < 0).tolist()))


def kept_bytes(text: bytes, runs: list[tuple[int, int]]) -> bytes:
    ends = [0, *(b for _, b in runs)]
    return b"".join(text[a:b] for a, b in zip(ends, [*(a for a, _ in runs), len(text)]))


def _found(docs: DataFrame, length: int, gram: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The scanned rows, the digests of texts that stand several times, and the cuts of the others."""
    scanned = settle(_scan(docs, length, gram), "cut-scan")
    copies = scanned.filter(F.col("n_bytes") >= length).groupBy("digest").agg(F.count("*").alias("n")).filter("n > 1").select("digest")
    copies = settle(copies, "cut-copies")
    return scanned, copies, settle(cuts(docs, scanned, length, gram).join(copies, "digest", "left_anti"), "cut-spans")


def removed(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, n_bytes, n_removed, n_spans and kept_sha256 (of the bytes that stay).

    A null text is empty; a text shorter than ``length`` keeps all. A text that stands in several rows goes as a
    whole, if it is that long, also where rows repeat as a whole. Keys are carried along, null ones too; other
    columns are not used. An empty table gives no rows.
    """
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    scanned, copies, spans = _found(rows, length, gram)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for digest, whole, found in zip(*(batch.column(c).to_pylist() for c in ("digest", "text", "spans"))):
                runs = _covered(len(whole), found)
                out.append((digest, sum(b - a for a, b in runs), len(runs), hashlib.sha256(kept_bytes(whole, runs)).hexdigest()))
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out) if out else [[]] * 4, (pa.binary(), pa.int64(), pa.int64(), pa.string()))], names=["digest", "cut", "runs", "left"])

    partly = _texts(rows, spans).join(spans, "digest").mapInArrow(lean(run), "digest binary, cut long, runs long, left string")
    whole = copies.select("digest", F.lit(None).cast("long").alias("cut"), F.lit(1).cast("long").alias("runs"), F.lit(_EMPTY_SHA).alias("left"))
    found = scanned.select("key", "digest", "n_bytes", "sha").join(whole.unionByName(partly), "digest", "left")
    touched = F.col("runs").isNotNull()
    return found.select(
        F.col("key").alias(key),
        "n_bytes",
        F.when(touched, F.coalesce("cut", "n_bytes")).otherwise(F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("runs", F.lit(0).cast("long")).alias("n_spans"),
        F.when(touched, F.col("left")).otherwise(F.col("sha")).alias("kept_sha256"),
    )


def _worded(column: pa.Array) -> list[bytes]:
    """Each text as the hashes of its words, parted by white space: strings of them are strings of so many words."""
    raw, at = text_bytes(column)
    starts, stops = word_spans(raw, at)
    whole = hash_spans(raw, starts, stops).astype("<u8").tobytes()
    ends = (np.searchsorted(starts, at) * WORD).tolist()
    return [whole[a:b] for a, b in zip(ends, ends[1:])]


def _in_words(docs: DataFrame) -> DataFrame:
    """key and text, the text as the hashes of its words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                yield pa.record_batch([part.column("key"), pa.array(_worded(part.column("text")), pa.binary())], names=["key", "text"])

    return docs.mapInArrow(lean(run), f"key {dict(docs.dtypes)['key']}, text binary")


def _repeats(rows: DataFrame, length: int, gram: int) -> DataFrame:
    """Per digest of a text of which something repeats: ``spans``, null if the text stands several times."""
    _, copies, spans = _found(rows, length, gram)
    return spans.unionByName(copies.select("digest", F.expr(f"CAST(NULL AS {dict(spans.dtypes)['spans']}) AS spans")))


def _word_runs(raw: bytes, spans: list[dict] | None) -> list[tuple[int, int]]:
    """What spans of the hashes of a text's words (None: all words) cover of the text; parts of a hash are no word."""
    starts, stops = word_spans(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
    runs = [(0, len(starts) * WORD)] if spans is None else _covered(len(starts) * WORD, spans)
    whole = [(-(-a // WORD), b // WORD) for a, b in runs]
    return [(int(starts[a]), int(stops[b - 1])) for a, b in whole if a < b]


def _union(runs: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(runs):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(b, out[-1][1]))
        else:
            out.append((a, b))
    return out


def clean(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, text: str = "text", n_words: int | None = None) -> DataFrame:
    """All rows and columns with what repeats cut out of the text; a character cut through goes as a whole.

    With ``n_words``, strings of so many words go too, however few bytes they have and whatever white space parts
    them; both kinds are found in the texts as they are. Null texts stay null. Rows without anything to cut pass by
    without a shuffle.
    """
    rows = docs.select(F.lit(None).cast("long").alias("key"), F.col(text).alias("text"))
    found = {"_bytes": _repeats(rows, length, gram)}
    if n_words:
        found["_words"] = _repeats(_in_words(rows), n_words * WORD, min(GRAM, n_words * WORD // 3))
    filters, names = {kind: _filter_of(spans) for kind, spans in found.items()}, docs.columns
    schema = ", ".join(f"`{name}` {kind}" for name, kind in docs.dtypes)
    added = [f"{kind}_digest" for kind in found]

    def tag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (part for batch in batches for part in pieces(batch, text)):
            column = part.column(text)
            told, maybe = [], np.zeros(part.num_rows, bool)
            for kind, table in filters.items():
                forms = [t.encode() if t is not None else None for t in column.to_pylist()] if kind == "_bytes" else _worded(column)
                digests = [_digest(form) if form is not None else b"" for form in forms]
                bits = [int.from_bytes(d[:4], "little") >> (32 - FILTER_BITS) for d in digests]
                maybe |= [bool(d) and bool(table[b >> 3] >> (b & 7) & 1) for d, b in zip(digests, bits)]
                told.append(pa.array(digests, pa.binary()))
            yield pa.record_batch([*part.columns, *told, pa.array(maybe)], names=[*names, *added, "_maybe"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            hits = [list(zip(batch.column(f"{kind}_spans").to_pylist(), batch.column(f"{kind}_hit").to_pylist())) for kind in filters]
            for whole, *by_kind in zip(batch.column(text).to_pylist(), *hits):
                if whole is not None and any(hit for _, hit in by_kind):
                    raw, runs = whole.encode(), []
                    for kind, (spans, hit) in zip(filters, by_kind):
                        if hit and kind == "_words":
                            runs += _word_runs(raw, spans)
                        elif hit:
                            runs += _covered(len(raw), spans) if spans is not None else [(0, len(raw))]
                    whole = kept_bytes(raw, _union(runs)).decode("utf-8", "ignore")
                out.append(whole)
            yield pa.record_batch([pa.array(out, batch.column(c).type) if c == text else batch.column(c) for c in names], names=names)

    tagged = docs.mapInArrow(lean(tag), f"{schema}, {', '.join(f'{c} binary' for c in added)}, _maybe boolean")
    touched = tagged.filter("_maybe")
    for kind, spans in found.items():
        hits = spans.select(F.col("digest").alias(f"{kind}_digest"), F.col("spans").alias(f"{kind}_spans"), F.lit(True).alias(f"{kind}_hit"))
        touched = touched.join(hits, f"{kind}_digest", "left")
    touched = touched.select(*names, *(f"{kind}_{c}" for kind in found for c in ("spans", "hit"))).mapInArrow(lean(cut), schema)
    return tagged.filter("NOT _maybe").select(*names).unionByName(touched)
