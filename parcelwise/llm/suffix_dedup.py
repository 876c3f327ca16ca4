"""Removal of byte strings that occur more than once in a corpus, by suffix arrays.

Method: suffix arrays of blocks of text (Larsson-Sadakane refinement), Kasai common prefixes, and a
binary search of one block's windows in another's order where a shard needs several blocks.  A window is
``length`` bytes of one text; every byte covered by a window that also begins anywhere else is removed.

Which text meets in a shard: the anchor of a window is the smallest hash of its ``GRAM``-byte strings.
Equal windows have equal anchors, so only runs of windows whose anchor occurs at least twice can be repeated,
and all equal windows go to the shard of their anchor.  The exact decision is made by the shard's suffix arrays.

Scale: anchors (one in about 80 bytes) are counted in shards of a bounded amount of text, per batch first, so a passage of a third of all
documents costs one entry per batch; marking spreads hot anchors over salts.  Equal pieces of text are one piece with a
count, so copies are sorted once.  An anchor with ``HOT`` or more different surroundings (the edge of a passage that
very many texts share) has its windows counted one by one, by the anchor and both ends of the window: those that occur once go,
those that occur ``MANY`` times or more stay runs of their anchor (the passage itself, the same in all texts), and the
few between go to shards of their own.  So an anchor brings a shard a bounded number of different pieces, and a block
holds at most ``BLOCK`` bytes and a piece.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize, text_key
from .suffix_array import Block
from .words import mix64, text_chunks

LENGTH, GRAM = 200, 40
BLOCK = 1 << 18
SALTS = 8
CHUNK = 1 << 15
RUN = 4096
SHARD_BYTES = 80 << 20   # text whose anchors, about a million, are one shard
HOT, MANY = 1000, 250
WINDOWS_PER_SHARD = 2_000_000
PIECE_ROWS = 2000
_ODD = [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F]
KNOWN = "shard int, keys binary, marks binary"
STREAM = "shard int, salt int, kind int, keys binary, places binary"


def _anchors(data: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """(position, hash) of the anchor of the window that begins at each position (as if the data were one text).

    Order among grams is the upper half of the hash, then the position, so equal windows have it at the same offset.
    """
    n = len(data) - length + 1
    if n <= 0:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    loads = np.ascontiguousarray(np.ndarray((len(data) - 7,), "<u8", buffer=data, strides=(1,)))  # aligned
    grams = len(data) - GRAM + 1
    h = np.zeros(grams, np.uint64)
    for i, c in enumerate(_ODD):
        h += loads[8 * i:8 * i + grams] * np.uint64(c)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xD6E8FEB86659FD93)
    low = (h & np.uint64(0xFFFFFFFF00000000)) | np.arange(grams, dtype=np.uint64)
    width, have = length - GRAM + 1, 1
    while have * 2 <= width:
        low = np.minimum(low[:-have], low[have:])
        have *= 2
    low = np.minimum(low[:n], low[width - have:width - have + n])
    at = (low & np.uint64(0xFFFFFFFF)).astype(np.int64)
    return at, h


def _runs(data: np.ndarray, offsets: np.ndarray, length: int):
    """(text, start in the text, number of windows, anchor hash, whether the anchor stands in several places) of runs of windows.

    A run is windows in a row with one anchor hash, at most ``RUN``.  Periodic text has the same anchor all along, so its
    runs are few however long it is; such a run can repeat itself.
    """
    at, h = _anchors(data, length)
    key = h[at]
    ends = np.repeat(offsets[1:], np.diff(offsets))[:len(at)]
    valid = np.arange(len(at)) + length <= ends
    new = np.ones(len(at), bool)
    if len(at):
        new[1:] = (key[1:] != key[:-1]) | ~valid[:-1]
    first = np.flatnonzero(valid & new)
    last = np.flatnonzero(valid & np.concatenate([new[1:] | ~valid[1:], [True]])) if len(at) else first
    several = at[first] != at[last]
    parts = -(-(last - first + 1) // RUN)
    if len(parts) and parts.max() > 1:
        nth = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        first, last, several = np.repeat(first, parts) + nth * RUN, np.repeat(last, parts), np.repeat(several, parts)
        last = np.minimum(last, first + RUN - 1)
    text = np.searchsorted(offsets, first, "right") - 1
    return text, first - offsets[text], last - first + 1, key[first], several


def _by_shard(df: DataFrame, keys: list[str], then: list[str]) -> DataFrame:
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys).sortWithinPartitions(*keys, *then)


def _split(shards: int, key: np.ndarray):
    """(shards in use, order of the rows by shard, cuts between them)."""
    shard = (mix64(key) % np.uint64(shards)).astype(np.int64)
    order = np.argsort(shard, kind="stable")
    names, cuts = np.unique(shard[order], return_index=True)
    return names, order, np.append(cuts, len(order))


def _parts(shards: int, key: np.ndarray):
    """(shard names, the rows of each)."""
    if not len(key):
        return [], []
    names, order, cuts = _split(shards, key)
    return names.astype(np.int32), [order[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


def _blobs(parts: list, values: np.ndarray) -> pa.Array:
    return pa.array([values[p].tobytes() for p in parts], pa.binary())


def _count(shards: int, length: int):
    """Per batch and shard: anchors, their occurrences (2 stands for more), the number of their different surroundings and one of these."""
    def run(batches):
        for batch in batches:
            found = []
            for _, _, data, offsets in text_chunks(batch.column("text"), CHUNK):
                text, _, n, key, several = _runs(data, offsets, length)
                same = text[1:] == text[:-1]
                before = np.concatenate([[0], np.where(same, key[:-1], 0)]).astype(np.uint64)[:len(key)]
                after = np.concatenate([np.where(same, key[1:], 0), [0]]).astype(np.uint64)[:len(key)]
                found.append((key, mix64(mix64(before) + mix64(~after) + n.astype(np.uint64)), several))
            key, around, several = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.empty(0, np.uint64),) * 3
            order = np.lexsort((around, key))
            key, around, several = key[order], around[order], several[order]
            first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.empty(0, np.int64)
            new = np.concatenate([[True], (key[1:] != key[:-1]) | (around[1:] != around[:-1])]) if len(key) else np.empty(0, bool)
            occurs = np.add.reduceat(1 + several.astype(np.int64), first) if len(first) else first
            kinds = np.add.reduceat(new, first) if len(first) else first
            names, parts = _parts(shards, key[first])
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.int32()), _blobs(parts, key[first]), _blobs(parts, np.minimum(occurs, 2).astype(np.uint8)),
                 _blobs(parts, kinds.astype(np.uint32)), _blobs(parts, around[first])], ["shard", "keys", "counts", "kinds", "around"])
    return run


def _folded(batches, columns: dict, close):
    """Sorted stream of packed rows: ``close(shard, arrays)`` for each shard with its columns put together."""
    shard, held = None, []
    for batch in batches:
        for s, *row in zip(*(batch.column(x).to_pylist() for x in ("shard", *columns)), strict=True):
            if s != shard and held:
                yield close(shard, [np.concatenate(x) for x in zip(*held, strict=True)])
                held = []
            shard = s
            held.append([np.frombuffer(blob, kind) for blob, kind in zip(row, columns.values(), strict=True)])
    if held:
        yield close(shard, [np.concatenate(x) for x in zip(*held, strict=True)])


def _known(shard: int, keys: np.ndarray, marks: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([keys.tobytes()], pa.binary()),
                                       pa.array([marks.astype(np.uint8).tobytes()], pa.binary())], ["shard", "keys", "marks"])


def _twice(hot: int):
    """One row per shard: the anchors that occur at least twice, and whether each is hot."""
    def close(shard, columns):
        key, count, kinds, around = columns
        keys, at = np.unique(key, return_inverse=True)
        total = np.bincount(at, weights=count)
        firsts = np.unique(np.stack([at.astype(np.uint64), around], 1), axis=0)[:, 0].astype(np.int64)
        different = np.bincount(at, weights=kinds - 1.0) + np.bincount(firsts, minlength=len(keys))
        return _known(shard, keys[total > 1], different[total > 1] >= hot)

    return lambda batches: _folded(batches, {"keys": np.uint64, "counts": np.uint8, "kinds": np.uint32, "around": np.uint64}, close)


def _sent(batch, shards: int, key: np.ndarray, places: list):
    """Packed rows of keys with their places (k1, k2 as 8, two numbers as 4 bytes), one per shard."""
    names, parts = _parts(shards, key)
    salt = int(xxhash.xxh3_64_intdigest(batch.column("k2").slice(0, 64).to_numpy(zero_copy_only=False).tobytes()) % SALTS)
    blobs = [b"".join(x[p].astype(kind).tobytes() for x, kind in zip(places, ("<i8", "<i8", "<i4", "<i4"), strict=True)) for p in parts]
    m = len(parts)
    return pa.RecordBatch.from_arrays([pa.array(names, pa.int32()), pa.array([salt] * m, pa.int32()), pa.array([1] * m, pa.int32()),
                                       _blobs(parts, key), pa.array(blobs, pa.binary())], ["shard", "salt", "kind", "keys", "places"])


def _placed(shards: int, length: int):
    def run(batches):
        for batch in batches:
            k1, k2 = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("k1", "k2"))
            rows = []
            for lo, _, data, offsets in text_chunks(batch.column("text"), CHUNK):
                text, start, n, key, _ = _runs(data, offsets, length)
                rows.append((key, k1[lo + text], k2[lo + text], start, n))
            if rows:
                key, *places = (np.concatenate(x) for x in zip(*rows, strict=True))
                yield _sent(batch, shards, key, places)
    return run


def _met(batches):
    """Sorted stream: a shard's known keys with their marks, then packed rows; (key, mark, k1, k2, two numbers) of the known ones."""
    shard, known, marks = None, np.empty(0, np.uint64), np.empty(0, np.uint8)
    for batch in batches:
        for s, kind, keys, places in zip(*(batch.column(c).to_pylist() for c in ("shard", "kind", "keys", "places")), strict=True):
            key = np.frombuffer(keys, np.uint64)
            if kind == 0:
                shard, known, marks = s, key, np.frombuffer(places, np.uint8)
                continue
            if s != shard or not len(known):
                continue
            at = np.minimum(np.searchsorted(known, key), len(known) - 1)
            keep = known[at] == key
            n = len(key)
            k1, k2 = np.frombuffer(places, "<i8", 2 * n).reshape(2, n)
            a, b = np.frombuffer(places, "<i4", 2 * n, 16 * n).reshape(2, n)
            yield tuple(x[keep] for x in (key, marks[at], k1, k2, a, b))


def _repeated(batches):
    """Runs whose anchor is known to repeat, and whether it is hot."""
    for key, hot, k1, k2, start, count in _met(batches):
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (k1, k2, start, count, key.view(np.int64), hot.astype(bool))],
                                         ["k1", "k2", "start", "n", "anchor", "hot"])


def _window_keys(text: np.ndarray, start: int, n: int, anchor: int, length: int) -> np.ndarray:
    """A hash for each window of a run: of the anchor and the window's first and last eight bytes."""
    at = start + np.arange(n)
    loads = np.ndarray((len(text) - 7,), "<u8", buffer=text, strides=(1,))
    base = np.array([anchor], np.int64).view(np.uint64)
    return mix64(mix64(loads[at] ^ base) + mix64(loads[at + length - 8] + base))


def _hot_windows(batch, length: int):
    """(row, run's start, offset of each window in the run, key) of the hot runs of a batch of candidates."""
    out = []
    for i, (text, *runs) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("text", "starts", "counts", "anchors", "hots")), strict=True)):
        data = np.frombuffer(text, np.uint8)
        for start, n, anchor, hot in zip(*runs, strict=True):
            if hot:
                out.append((np.full(n, i), np.full(n, start), np.arange(n), _window_keys(data, start, n, anchor, length)))
    return [np.concatenate(x) for x in zip(*out, strict=True)] if out else [np.empty(0, np.int64)] * 3 + [np.empty(0, np.uint64)]


def _count_windows(shards: int, length: int):
    def run(batches):
        for batch in _slices(batches):
            key, n = np.unique(_hot_windows(batch, length)[3], return_counts=True)
            names, parts = _parts(shards, key)
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.int32()), _blobs(parts, key), _blobs(parts, n.astype(np.uint32))],
                                             ["shard", "keys", "counts"])
    return run


def _window_classes(many: int):
    def close(shard, columns):
        keys, at = np.unique(columns[0], return_inverse=True)
        total = np.bincount(at, weights=columns[1])
        return _known(shard, keys[total > 1], total[total > 1] >= many)

    return lambda batches: _folded(batches, {"keys": np.uint64, "counts": np.uint32}, close)


def _place_windows(shards: int, length: int):
    def run(batches):
        for batch in _slices(batches):
            row, start, offset, key = _hot_windows(batch, length)
            k1, k2 = (batch.column(c).to_numpy(zero_copy_only=False)[row] for c in ("k1", "k2"))
            if len(key):
                yield _sent(batch, shards, key, [k1, k2, start, offset])
    return run


def _window_marks(batches):
    """Per run: the offsets of its repeated windows, and whether each occurs many times."""
    for _, many, k1, k2, start, offset in _met(batches):
        if not len(k1):
            continue
        order = np.lexsort((offset, start, k2, k1))
        k1, k2, start, offset, many = (x[order] for x in (k1, k2, start, offset, many))
        first = np.flatnonzero(np.concatenate([[True], (k1[1:] != k1[:-1]) | (k2[1:] != k2[:-1]) | (start[1:] != start[:-1])]))
        cuts = [slice(a, b) for a, b in zip(first, np.append(first[1:], len(k1)), strict=True)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(k1[first]), pa.array(k2[first]), pa.array(start[first]), pa.array([offset[c].astype("<i4").tobytes() for c in cuts], pa.binary()),
             pa.array([many[c].tobytes() for c in cuts], pa.binary())], ["k1", "k2", "start", "offsets", "many"])


def _refined(length: int):
    """Candidates with each hot run replaced by runs of its windows that occur many times, and its other repeated windows."""
    def run(batches):
        for batch in _slices(batches):
            out = {"starts": [], "counts": [], "anchors": []}
            for text, starts, counts, anchors, hots, marks in zip(
                    *(batch.column(c).to_pylist() for c in ("text", "starts", "counts", "anchors", "hots", "marks")), strict=True):
                by_start: dict[int, dict] = {}
                for mark in marks or ():
                    pairs = zip(np.frombuffer(mark["offsets"], "<i4").tolist(), mark["many"], strict=True)
                    by_start.setdefault(mark["start"], {}).update(pairs)
                runs, data = [], np.frombuffer(text, np.uint8)
                for start, n, anchor, hot in zip(starts, counts, anchors, hots, strict=True):
                    if not hot:
                        runs.append((start, n, anchor))
                        continue
                    last = None
                    for offset, many in sorted(by_start.get(start, {}).items()):
                        if not many:
                            own = _window_keys(data, start + offset, 1, anchor, length).view(np.int64)
                            runs.append((start + offset, 1, int(own[0])))
                        elif last is not None and sum(runs[last][:2]) == start + offset:
                            runs[last] = (runs[last][0], runs[last][1] + 1, anchor)
                        else:
                            last = len(runs)
                            runs.append((start + offset, 1, anchor))
                for name, values in zip(out, zip(*runs, strict=True) if runs else ((), (), ()), strict=True):
                    out[name].append(list(values))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("k1", "k2", "doc_id", "n_bytes", "text")),
                 *(pa.array(out[c], pa.list_(kind)) for c, kind in (("starts", pa.int32()), ("counts", pa.int32()), ("anchors", pa.int64())))],
                ["k1", "k2", "doc_id", "n_bytes", "text", "starts", "counts", "anchors"])
    return run


def _slices(batches):
    return (b.slice(i, PIECE_ROWS) for b in batches for i in range(0, b.num_rows, PIECE_ROWS))


def _candidates(length: int):
    """Texts without a candidate run are done; the others are passed on with their runs."""
    def run(batches):
        for batch in batches:
            texts = batch.column("text").to_pylist()
            runs = batch.column("runs").to_pylist()
            sha = [None if r else hashlib.sha256(t or b"").hexdigest() for t, r in zip(texts, runs, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("k1"), batch.column("k2"), batch.column("doc_id"), pa.array([len(t or b"") for t in texts], pa.int64()),
                 pa.array(sha, pa.string()), pa.array([t if r else None for t, r in zip(texts, runs, strict=True)], pa.binary()),
                 *(pa.array([[x[c] for x in r] if r else None for r in runs], pa.list_(kind))
                   for c, kind in (("start", pa.int32()), ("n", pa.int32()), ("anchor", pa.int64()), ("hot", pa.bool_())))],
                ["k1", "k2", "doc_id", "n_bytes", "sha", "text", "starts", "counts", "anchors", "hots"])
    return run


def _each_piece(batch, length: int):
    for i, (text, starts, counts, anchors) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("text", "starts", "counts", "anchors")),
                                                            strict=True)):
        for start, n, anchor in zip(starts, counts, anchors, strict=True):
            yield i, start, anchor, text[start:start + n - 1 + length]


def _digest(piece: bytes) -> bytes:
    return xxhash.xxh3_128_digest(piece)


def _pieces(length: int):
    """Distinct pieces of a batch with the number of times each occurs."""
    def run(batches):
        for batch in _slices(batches):
            held: dict[bytes, list] = {}
            for _, _, anchor, piece in _each_piece(batch, length):
                held.setdefault(_digest(piece), [0, anchor, piece])[0] += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([v[1] for v in held.values()], pa.int64()), pa.array(list(held), pa.binary()),
                 pa.array([v[0] for v in held.values()], pa.int64()), pa.array([v[2] for v in held.values()], pa.binary())],
                ["anchor", "digest", "n", "piece"])
    return run


def _occurrences(length: int):
    def run(batches):
        for batch in _slices(batches):
            rows = [(i, start, _digest(piece)) for i, start, _, piece in _each_piece(batch, length)]
            at = pa.array([r[0] for r in rows], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("k1").take(at), batch.column("k2").take(at), pa.array([r[1] for r in rows], pa.int32()),
                                              pa.array([r[2] for r in rows], pa.binary())], ["k1", "k2", "start", "digest"])
    return run


def flag_blocks(blocks: list[list[tuple]], length: int) -> list[tuple[bytes, bytes]]:
    """(digest, spans) of the pieces of blocks whose windows meet only each other and that hold repeated ones.

    spans are the maximal runs of bytes that repeated windows cover, as pairs of little-endian 4-byte numbers.  A block is a list of (anchor, digest, count, piece).  Only the anchors that lie in two blocks are searched across.
    """
    built, flags, weights = [], [], []
    for block in blocks:
        b = Block.of([p[3] for p in block], length)
        weight = np.repeat([p[2] for p in block], [len(p[3]) for p in block])
        built.append(b)
        weights.append(weight)
        flags.append(b.repeated(weight))
    for i in range(1, len(built)):
        for j in range(i):
            mine = built[i].firsts()
            found = built[j].find(built[i], mine)
            hit = found >= 0
            for k, groups in ((i, built[i].group[_place(built[i], mine[hit])]), (j, found[hit])):
                order = built[k].sa
                flags[k][order[np.isin(built[k].group, groups) & built[k].valid[order]]] = True
    out = []
    for block, flag in zip(blocks, flags, strict=True):
        at = 0
        for _, digest, _, piece in block:
            own = flag[at:at + len(piece) - length + 1]
            at += len(piece)
            if own.any():
                edge = np.diff(own.astype(np.int8), prepend=0, append=0)
                first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1 + length
                out.append((digest, np.stack([first, last], 1).astype("<i4").tobytes()))
    return out


def _place(block: Block, positions: np.ndarray) -> np.ndarray:
    place = np.empty(len(block.sa), np.int64)
    place[block.sa] = np.arange(len(block.sa))
    return place[positions]


def _flagged(length: int):
    """Sorted stream of pieces by anchor: builds blocks and gives the repeated windows of each piece.

    Blocks are cut between anchors; an anchor that fills more than one block gets blocks of its own, merged with each other.
    Such an anchor has fewer than ``HOT`` different pieces, so it fills a few blocks at most.
    """
    def run(batches):
        whole, held, own, size, last = [], 0, [], 0, None  # closed anchors of a block and their bytes; the current anchor's

        def emit(blocks):
            found = flag_blocks(blocks, length)
            return pa.RecordBatch.from_arrays([pa.array([d for d, _ in found], pa.binary()), pa.array([f for _, f in found], pa.binary())],
                                              ["digest", "spans"])

        def cut(rows):
            blocks, held = [[]], 0
            for r in rows:
                if held + len(r[3]) > BLOCK and blocks[-1]:
                    blocks.append([])
                    held = 0
                blocks[-1].append(r)
                held += len(r[3])
            return blocks

        for batch in batches:
            for anchor, digest, n, piece in zip(*(batch.column(c).to_pylist() for c in ("anchor", "digest", "n", "piece")), strict=True):
                if anchor == last and own[-1][1] == digest:
                    own[-1][2] += n
                    continue
                if anchor != last and own:
                    if size > BLOCK:
                        yield emit(cut(own))
                    else:
                        whole, held = whole + own, held + size
                        if held >= BLOCK:
                            yield emit([whole])
                            whole, held = [], 0
                    own, size = [], 0
                own.append([anchor, digest, n, piece])
                size += len(piece)
                last = anchor
        if size > BLOCK:
            yield emit(cut(own))
            own = []
        if whole or own:
            yield emit([whole + own])
    return run


def _removed(batches):
    for batch in batches:
        marks = batch.column("marks")
        held = marks.flatten()
        starts, spans_of = held.field("start").to_numpy(zero_copy_only=False), held.field("spans").to_pylist()
        ends = np.cumsum(np.nan_to_num(pc.list_value_length(marks).to_numpy(zero_copy_only=False)).astype(np.int64))
        spans, kept, gone = [], [], []
        for text, a, b in zip(batch.column("text").to_pylist(), [0, *ends[:-1].tolist()], ends.tolist(), strict=True):
            own = np.frombuffer(b"".join(spans_of[a:b]), "<i4").reshape(-1, 2).astype(np.int64)
            own = own + np.repeat(starts[a:b], [len(x) // 8 for x in spans_of[a:b]])[:, None]
            change = np.bincount(own[:, 0], minlength=len(text) + 1) - np.bincount(own[:, 1], minlength=len(text) + 1)
            cover = np.cumsum(change[:-1]) > 0
            edge = np.diff(cover.astype(np.int8), prepend=0, append=0)
            spans.append(np.stack([np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)], 1).astype("<i8").tobytes())
            kept.append(np.frombuffer(text, np.uint8)[~cover].tobytes())
            gone.append(int(cover.sum()))
        yield pa.RecordBatch.from_arrays(
            [batch.column("k1"), batch.column("k2"), batch.column("doc_id"), batch.column("n_bytes"), pa.array(gone, pa.int64()),
             pa.array([len(s) // 16 for s in spans], pa.int64()), pa.array(spans, pa.binary()),
             pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string()), pa.array(kept, pa.binary())],
            ["k1", "k2", "doc_id", "n_bytes", "n_removed", "n_spans", "spans", "kept_sha256", "kept"])


def _with_known(known: DataFrame, rows: DataFrame) -> DataFrame:
    """Packed rows sorted by shard and salt, behind the shard's known keys."""
    heads = known.select("shard", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"), F.lit(0).alias("kind"), "keys",
                         F.col("marks").alias("places"))
    return _by_shard(heads.unionByName(rows), ["shard", "salt"], ["kind"])


def _without_hot_anchors(found: DataFrame, length: int) -> DataFrame:
    """Candidates (k1, k2, doc_id, n_bytes, text, starts, counts, anchors) whose hot runs are taken apart."""
    is_hot = F.exists("hots", lambda h: h)
    plain, hot = found.where(~is_hot).drop("hots"), found.where(is_hot)
    windows = hot.select(F.aggregate(F.zip_with("counts", "hots", lambda n, h: F.when(h, n).otherwise(0)), F.lit(0), lambda a, b: a + b)
                         .alias("n")).agg(F.sum("n")).first()[0]
    if not windows:
        return plain
    shards = -(-windows // WINDOWS_PER_SHARD)
    given = hot.select("k1", "k2", "text", "starts", "counts", "anchors", "hots")
    counted = given.mapInArrow(_count_windows(shards, length), "shard int, keys binary, counts binary")
    known = materialize(_by_shard(counted, ["shard"], []).mapInArrow(_window_classes(MANY), KNOWN), "windows")
    marks = _with_known(known, given.mapInArrow(_place_windows(shards, length), STREAM)).mapInArrow(
        _window_marks, "k1 long, k2 long, start int, offsets binary, many binary")
    marks = marks.groupBy("k1", "k2").agg(F.collect_set(F.struct("start", "offsets", "many")).alias("marks"))
    refined = hot.join(marks, ["k1", "k2"], "left").mapInArrow(
        _refined(length), "k1 long, k2 long, doc_id long, n_bytes long, text binary, starts array<int>, counts array<int>, anchors array<long>")
    return plain.unionByName(materialize(refined, "refined"))


def remove_repeats(docs: DataFrame, length: int = LENGTH, shards: int | None = None) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): k1, k2, doc_id, n_bytes, n_removed, n_spans, spans, kept_sha256, kept.

    spans holds the maximal removed runs as pairs of little-endian longs; kept the bytes left, concatenated (null,
    like spans, for texts of which nothing is removed for want of any repeated anchor).  Null texts are empty.
    Repeated rows repeat each other's text and so lose every window.  Other columns are ignored; no rows give no rows.
    """
    spark = docs.sparkSession
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text"),
                      *text_key(docs))
    if shards is None:
        size = own.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        shards = max(2 * int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // SHARD_BYTES))
    counted = own.select("text").mapInArrow(_count(shards, length), "shard int, keys binary, counts binary, kinds binary, around binary")
    known = materialize(_by_shard(counted, ["shard"], []).mapInArrow(_twice(HOT), KNOWN), "anchors")
    lines = own.select("k1", "k2", "text").mapInArrow(_placed(shards, length), STREAM)
    runs = _with_known(known, lines).mapInArrow(_repeated, "k1 long, k2 long, start int, n int, anchor long, hot boolean")
    runs = runs.groupBy("k1", "k2").agg(F.collect_set(F.struct("start", "n", "anchor", "hot")).alias("runs"))
    marked = materialize(own.join(runs, ["k1", "k2"], "left").mapInArrow(
        _candidates(length), "k1 long, k2 long, doc_id long, n_bytes long, sha string, text binary, starts array<int>, "
                             "counts array<int>, anchors array<long>, hots array<boolean>"), "candidates")
    found = _without_hot_anchors(marked.where("text IS NOT NULL").drop("sha"), length)
    pieces = found.select("text", "starts", "counts", "anchors").mapInArrow(_pieces(length), "anchor long, digest binary, n long, piece binary")
    flags = materialize(_by_shard(pieces, ["anchor"], ["digest"]).mapInArrow(_flagged(length), "digest binary, spans binary"), "flags")
    marks = found.select("k1", "k2", "text", "starts", "counts", "anchors").mapInArrow(
        _occurrences(length), "k1 long, k2 long, start int, digest binary").join(flags, "digest")
    marks = marks.groupBy("k1", "k2").agg(F.collect_set(F.struct("start", "spans")).alias("marks"))
    cleaned = found.select("k1", "k2", "doc_id", "n_bytes", "text").join(marks, ["k1", "k2"], "left").mapInArrow(
        _removed, "k1 long, k2 long, doc_id long, n_bytes long, n_removed long, n_spans long, spans binary, kept_sha256 string, kept binary")
    plain = marked.where("text IS NULL").select(
        "k1", "k2", "doc_id", "n_bytes", F.lit(0).cast("long").alias("n_removed"), F.lit(0).cast("long").alias("n_spans"),
        F.lit(None).cast("binary").alias("spans"), F.col("sha").alias("kept_sha256"), F.lit(None).cast("binary").alias("kept"))
    return plain.unionByName(cleaned)
