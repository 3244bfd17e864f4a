"""Bytes covered by a long string that also starts earlier, by merged Burrows-Wheeler transforms of shards.

Suffixes of a whole corpus fit no machine, so strings that can repeat are brought together first. The least hash
of the ``K``-byte pieces of a window depends on the window alone, hence equal windows carry the same least piece.
Runs of windows with one least piece are strings a little longer than a window; only those whose piece occurs
twice are kept, dealt by that piece. Each bucket cuts its distinct strings into shards, sorts the suffixes of
each shard alone, and merges the transforms: every round takes suffixes one symbol to the left (LF) and refines
the interleaving by that symbol, so that after ``length`` rounds suffixes stand together exactly if their first
``length`` symbols agree. No suffix of two shards is compared or sorted again. Only suffixes that arrive at the
start of a window are followed, and those alone in their block, which stay alone, are left out of later rounds.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.session import staged

#: Bytes of a piece whose hash chooses the bucket of a window.
K = 32
#: Bytes of text in a batch, of windows hashed at a time and of a shard; bounds on memory alone.
BATCH, CHUNK, SHARD = 4 << 20, (1 << 20) - (1 << 12), 1 << 19
#: A piece with more strings than this is dealt by its single windows instead, so that no bucket outgrows a task.
HOT = 1 << 14
#: No UTF-8 text holds this byte; it ends each document of a batch.
END = 0xFF
_NO_ID = np.iinfo(np.int64).min
_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_PLACE = np.uint64((1 << 20) - 1)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX
    return x ^ (x >> np.uint64(29))


def _piece_hashes(data: np.ndarray) -> np.ndarray:
    """Hash of the ``K`` bytes at each place, by doubling."""
    out, power, width = data.astype(np.uint64) + np.uint64(1), _FACTOR, 1
    while width < K:
        out = out[: len(out) - width] * power + out[width:]
        power, width = power * power, 2 * width
    return _mixed(out)


def _least(values: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` neighbours."""
    out, n, m = values, len(values) - width + 1, 1
    while 2 * m <= width:
        out = np.minimum(out[: len(out) - m], out[m:])
        m *= 2
    return np.minimum(out[:n], out[width - m : width - m + n])


def runs_of(data: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place, number of windows, piece hash) of the runs of neighbouring windows with the same least piece.

    The first one counts if a window holds several, so no window comes twice in a run. ``ends`` are the places of the
    bytes that end documents; windows that hold one are left out.
    """
    usable = np.ones(max(0, len(data) - length + 1), bool)
    for end in ends.tolist():
        usable[max(0, end - length + 1) : end + 1] = False
    found = []
    with np.errstate(over="ignore"):
        for at in range(0, len(usable), CHUNK):
            ok = usable[at : at + CHUNK]
            if not ok.any():
                continue
            hashes = _piece_hashes(data[at : at + len(ok) + length - 1])
            # The upper bits of a hash and its place: the least of these is the first of the least hashes.
            least = _least((hashes & ~_PLACE) | np.arange(len(hashes), dtype=np.uint64), length - K + 1)
            new = np.ones(len(ok) + 1, bool)
            new[1:-1] = (least[1:] != least[:-1]) | (ok[1:] != ok[:-1])
            starts = np.flatnonzero(new)
            sizes = np.diff(starts)
            keep = ok[starts[:-1]]
            starts, sizes = starts[:-1][keep], sizes[keep]
            found.append((starts + at, sizes, _mixed(hashes[(least[starts] & _PLACE).astype(np.int64)])))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    return tuple(np.concatenate(part) for part in zip(*found))


def _batch(rows: pa.Table) -> tuple[bytes, np.ndarray, list, list]:
    """One buffer of the batch's distinct documents in order of (id, hash of the text), the ends, keys and copies."""
    ids, ties, texts = rows["id"].to_pylist(), rows["tie"].to_pylist(), rows["body"].to_pylist()
    copies: dict = {}
    for i, key in enumerate(zip((_NO_ID if i is None else i for i in ids), ties, texts)):
        copies.setdefault(key, []).append(i)
    order = sorted(copies)
    stop = bytes([END])
    data = b"".join(text + stop for _, _, text in order)
    ends = np.cumsum([len(text) + 1 for _, _, text in order], dtype=np.int64) - 1
    return data, ends, [(i, tie) for i, tie, _ in order], [copies[key] for key in order]


def _numbers(value: bytes, kind=np.int64) -> np.ndarray:
    return np.frombuffer(value, kind)


def _narrow(values) -> bytes:
    """Whole numbers from 0 in 4 bytes each, or 8 where one needs them."""
    values = np.array(values, np.uint64)
    return values.astype(np.uint32 if values.max(initial=0) < 1 << 32 else np.uint64).tobytes()


def _widened(value: bytes, n: int) -> np.ndarray:
    return _numbers(value, np.uint32 if len(value) == 4 * n else np.uint64).astype(np.int64)


def _suffixes(text: np.ndarray) -> np.ndarray:
    """Rank of each suffix of a shard; the last symbol is 0 and occurs once."""
    n = len(text)
    padded = np.concatenate([text, np.zeros(8, np.uint8)]).astype(np.uint64)
    key = np.zeros(n, np.uint64)
    for i in range(8):
        key = (key << np.uint64(8)) | padded[i : i + n]
    depth = 8
    while True:
        order = np.argsort(key)
        ordered = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
        if rank[order[-1]] == n - 1:
            return rank
        after = np.zeros(n, np.int64)
        after[: max(0, n - depth)] = rank[depth:] + 1
        key = (rank * (n + 1) + after).astype(np.uint64)
        depth *= 2


def merged(shards: list[np.ndarray], length: int, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place, block) of the ``chosen`` suffixes whose first ``length`` symbols occur twice or more among these.

    ``chosen`` flags places; they count through the shards one after the other. Each shard ends with its only 0.
    After n rounds a suffix agrees with those of its block in n symbols; it began n places to the right.
    """
    before, left, place, offset = [], [], [], 0
    for text in shards:
        rank = _suffixes(text)
        order = np.empty(len(text), np.int64)
        order[rank] = np.arange(len(text))
        before.append(text[order - 1])
        left.append((rank[order - 1] + offset).astype(np.int32))
        place.append(order + offset)
        offset += len(text)
    transform, to_left, place = np.concatenate(before), np.concatenate(left), np.concatenate(place)
    starts = np.cumsum([0, *map(len, shards)])
    begins = np.zeros(offset, bool)
    for start, stop in zip(starts[:-1].tolist(), starts[1:].tolist()):
        begins[start:stop] = np.roll(chosen[start:stop], length)
    interleaved = np.flatnonzero(begins[place]).astype(np.int32)
    block = np.zeros(len(interleaved), np.int32)
    for _ in range(length):
        symbol = transform[interleaved]
        by = np.argsort(symbol, kind="stable")
        symbol, block = symbol[by], block[by]
        interleaved = to_left[interleaved[by]]
        new = np.ones(len(by) + 1, bool)
        new[1:-1] = (symbol[1:] != symbol[:-1]) | (block[1:] != block[:-1])
        shared = ~(new[:-1] & new[1:])
        block = np.cumsum(new[:-1], dtype=np.int32)
        if not shared.all():
            interleaved, block = interleaved[shared], block[shared]
        if not len(block):
            break
    return place[interleaved], block


def _shards(strings: list[bytes]) -> Iterator[tuple[np.ndarray, list[int]]]:
    """Strings (as symbols from 2 on, each ended by a 1) in shards; the last symbol is 0."""
    held: list[bytes] = []
    size = 0
    for text in [*strings, None]:
        if held and (text is None or size + len(text) > SHARD):
            yield np.concatenate([_numbers(b"".join(t + bytes([END]) for t in held), np.uint8) + np.uint8(2), np.zeros(1, np.uint8)])
            held, size = [], 0
        if text is not None:
            held.append(text)
            size += len(text) + 1


def later_windows(strings: list[bytes], classes: np.ndarray, keys: list[tuple], length: int) -> dict[int, np.ndarray]:
    """Of distinct ``strings`` that start at ``keys`` (id, tie, place): the windows that also start earlier, by string.

    Only strings of one class can share a window; a string alone in its class needs no look.
    """
    _, inverse, counts = np.unique(classes, return_inverse=True, return_counts=True)
    chosen = np.flatnonzero(counts[inverse] > 1)
    if not len(chosen):
        return {}
    chosen = chosen[np.argsort(inverse[chosen], kind="stable")]
    texts = [strings[i] for i in chosen.tolist()]
    shards = list(_shards(texts))
    # A shard holds one symbol more than its strings and their ends.
    fits = np.cumsum([len(s) for s in shards])
    sizes = np.array([len(t) for t in texts])
    starts = np.cumsum(sizes + 1) - sizes - 1
    starts += np.searchsorted(fits - np.arange(1, len(fits) + 1), starts, side="right")
    edge = np.zeros(fits[-1] + 1, np.int8)
    edge[starts] = 1
    edge[starts + sizes - length + 1] -= 1
    places, block = merged(shards, length, np.cumsum(edge[:-1]) > 0)
    at = np.searchsorted(starts, places, side="right") - 1
    offset = places - starts[at]
    ids, ties, begins = (np.array(part, np.int64) for part in zip(*(keys[i] for i in chosen.tolist())))
    order = np.lexsort((begins[at] + offset, ties[at], ids[at], block))
    at, offset, block = at[order], offset[order], block[order]
    later = np.concatenate([[False], block[1:] == block[:-1]]) if len(block) else np.zeros(0, bool)
    at, offset = at[later], offset[later]
    order = np.lexsort((offset, at))
    at, offset = at[order], offset[order]
    cut = np.flatnonzero(np.diff(at, prepend=-1))
    return {int(chosen[at[i]]): part for i, part in zip(cut.tolist(), np.split(offset, cut[1:]))}


def _joined(offsets: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Spans covered by the windows at sorted ``offsets``."""
    new = np.flatnonzero(np.diff(offsets, prepend=-length - 1) > length)
    last = np.append(new[1:] - 1, len(offsets) - 1)
    return offsets[new], offsets[last] + length


_PIECES = pa.schema([("bucket", pa.int32()), ("batch", pa.int32()), ("pieces", pa.binary()), ("counts", pa.binary())])
_FLAGS = pa.schema([("batch", pa.int32()), ("bucket", pa.int32()), ("flags", pa.binary())])
#: Strings of a batch that lie in a bucket, compressed, and the documents they are from; bucket -1 has places alone.
_STRINGS = pa.schema(
    [
        ("bucket", pa.int32()), ("batch", pa.int32()),
        *((c, pa.binary()) for c in ("strings", "lengths", "classes", "places", "documents", "ids", "ties", "begins")),
    ]
)
_SPANS = pa.schema([("batch", pa.int32()), ("starts", pa.binary()), ("stops", pa.binary())])


def _spark_schema(schema: pa.Schema) -> str:
    return ", ".join(f"{f.name} {'binary' if f.type == pa.binary() else 'int'}" for f in schema)


def _rows(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    return pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema) if rows else schema.empty_table()


def _by_bucket(pieces: np.ndarray, buckets: int) -> Iterator[tuple[int, np.ndarray]]:
    """(bucket, places in sorted ``pieces``)."""
    bucket = (pieces % np.uint64(buckets)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    cut = np.flatnonzero(np.diff(bucket[order], prepend=-1))
    for i, part in zip(cut.tolist(), np.split(order, cut[1:]) if len(cut) else ()):
        yield int(bucket[order[i]]), part


def remove_repeats(
    docs: DataFrame, length: int = 100, *, id_column: str = "doc_id", text_column: str = "text", batch: int = BATCH, hot: int = HOT
) -> DataFrame:
    """Every document without the bytes covered by a ``length``-byte string that also starts earlier.

    Returns the id, ``n_bytes``, ``n_removed``, ``n_spans``, ``spans`` (array of start and stop, in bytes) and ``kept``
    (the remaining bytes; a cut may fall inside a character). Earlier means a smaller id, or an earlier place in the same
    document. All strings are judged on the input. Matches never cross documents.

    Null texts are empty; texts shorter than ``length`` stay whole. A null id comes before all others; rows of one id
    are ordered by the hash of their texts; rows that repeat id and text are one document and each get its result.
    An empty table gives no rows; other columns are not read. ``length`` must be above 32 and below 4096.

    Texts are dealt into batches by hash, twice. A batch sends the hashes of its pieces, learns which occur elsewhere, and
    sends the strings around those, each once per batch; strings of one batch that come again in it are settled there.
    """
    if not K < length < 4096:
        raise ValueError(f"strings must have more than {K} and less than 4096 bytes")
    body = F.coalesce(F.col(text_column).cast("string"), F.lit("")).cast("binary")
    plain = docs.select(F.col(id_column).cast("long").alias("id"), body.alias("body"))
    total = plain.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    n = max(1, -(-total // batch))
    tie = F.xxhash64("body")
    texts = plain.select("id", "body", tie.alias("tie"), F.pmod(F.xxhash64("id", tie), F.lit(n)).cast("int").alias("batch"))

    def pieces_of(table: pa.Table) -> pa.Table:
        data, ends, _, _ = _batch(table)
        _, _, pieces = runs_of(_numbers(data, np.uint8), ends, length)
        found, counts = np.unique(pieces, return_counts=True)
        own, counts = table["batch"][0].as_py(), np.minimum(counts, 255).astype(np.uint8)
        return _rows([(b, own, found[at].tobytes(), counts[at].tobytes()) for b, at in _by_bucket(found, n)], _PIECES)

    def flags_of(table: pa.Table) -> pa.Table:
        """Of each batch's pieces: 1 if another batch has it too, 2 if it has too many strings."""
        pieces = [_numbers(p, np.uint64) for p in table["pieces"].to_pylist()]
        counts = np.concatenate([_numbers(c, np.uint8) for c in table["counts"].to_pylist()])
        _, inverse, seen = np.unique(np.concatenate(pieces), return_inverse=True, return_counts=True)
        total = np.bincount(inverse, counts)
        flags = ((seen > 1).astype(np.uint8) + (total > hot) * np.uint8(2))[inverse]
        parts = np.split(flags, np.cumsum([len(p) for p in pieces])[:-1])
        return _rows([(a, b, f.tobytes()) for a, b, f in zip(table["batch"].to_pylist(), table["bucket"].to_pylist(), parts)], _FLAGS)

    def strings_of(left: pa.Table, right: pa.Table) -> pa.Table:
        data, ends, keys, _ = _batch(left)
        places, sizes, pieces = runs_of(_numbers(data, np.uint8), ends, length)
        found, inverse, counts = np.unique(pieces, return_inverse=True, return_counts=True)
        flags = (counts > 1).astype(np.uint8)
        told = dict(zip(right["bucket"].to_pylist(), right["flags"].to_pylist()))
        for bucket, at in _by_bucket(found, n):
            flags[at] |= _numbers(told[bucket], np.uint8)
        own = left["batch"][0].as_py() if left.num_rows else 0
        begins = np.concatenate([[0], ends[:-1] + 1]).tolist() if len(ends) else []
        out: dict[int, list] = {}
        known: set[bytes] = set()
        local: list[tuple[int, int]] = []
        chosen = np.flatnonzero(flags[inverse])
        document = np.searchsorted(ends, places[chosen])
        rows = zip(places[chosen].tolist(), sizes[chosen].tolist(), pieces[chosen].tolist(), flags[inverse[chosen]].tolist(), document.tolist())
        for place, size, piece, flag, doc in rows:
            for at, windows in ((place, size),) if flag < 2 else ((place + i, 1) for i in range(size)):
                string = data[at : at + windows + length - 1]
                if string in known:
                    local.append((at, len(string)))
                    continue
                known.add(string)
                if flag > 1:
                    piece = int.from_bytes(hashlib.blake2b(string, digest_size=8).digest(), "little")
                out.setdefault(piece % n, []).append((string, len(string), piece >> 32, at, doc))
        result = []
        if local:
            at, size = zip(*local)
            result.append((-1, own, b"", np.array(size, np.uint16).tobytes(), b"", _narrow(at), *[b""] * 4))
        for bucket, entries in out.items():
            strings, lengths, classes, at, of = zip(*entries)
            used, which = np.unique(np.array(of), return_inverse=True)
            about = (np.array(c, np.int64).tobytes() for c in zip(*((*keys[d], begins[d]) for d in used.tolist())))
            packed = zlib.compress(b"".join(strings), 1)
            sizes = np.array(lengths, np.uint16).tobytes()
            result.append((bucket, own, packed, sizes, np.array(classes, np.uint32).tobytes(), _narrow(at), _narrow(which), *about))
        return _rows(result, _STRINGS)

    def spans_of(table: pa.Table) -> pa.Table:
        """Spans to remove, by batch: all of a string that starts earlier elsewhere, else its windows that do."""
        first: dict[bytes, int] = {}
        strings, classes, keys, refs = [], [], [], []
        for row in table.to_pylist():
            packed = zlib.decompress(row["strings"])
            lengths = _numbers(row["lengths"], np.uint16).astype(np.int64)
            places, of = (_widened(row[c], len(lengths)) for c in ("places", "documents"))
            about = list(zip(*(_numbers(row[c]).tolist() for c in ("ids", "ties", "begins"))))
            columns = (np.cumsum(lengths), lengths, _numbers(row["classes"], np.uint32), places, of)
            for stop, size, kind, place, document in zip(*(c.tolist() for c in columns)):
                own, tie, begin = about[document]
                string, key = packed[stop - size : stop], (own, tie, place - begin)
                at = first.setdefault(string, len(strings))
                if at == len(strings):
                    strings.append(string)
                    classes.append(kind)
                    keys.append(key)
                elif key < keys[at]:
                    keys[at] = key
                refs.append((at, key, row["batch"], place))
        later = later_windows(strings, np.array(classes, np.uint32), keys, length)
        found: dict[int, list] = {}
        for at, key, own, place in refs:
            if key != keys[at]:
                found.setdefault(own, []).append((place, place + len(strings[at])))
            elif at in later:
                starts, stops = _joined(later[at], length)
                found.setdefault(own, []).extend(zip((starts + place).tolist(), (stops + place).tolist()))
        out = []
        for own, spans in found.items():
            starts, stops = np.array(spans, np.int64).T
            out.append((own, starts.tobytes(), stops.tobytes()))
        return _rows(out, _SPANS)

    kept_schema = pa.schema(
        [
            ("id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()),
            ("spans", pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))), ("kept", pa.binary()),
        ]
    )

    def kept_of(left: pa.Table, right: pa.Table) -> pa.Table:
        data, ends, keys, copies = _batch(left)
        covered = np.zeros(len(data) + 1, np.int32)
        for starts, stops in zip(right["starts"].to_pylist(), right["stops"].to_pylist()):
            np.add.at(covered, _numbers(starts), 1)
            np.add.at(covered, _numbers(stops), -1)
        gone = np.cumsum(covered) > 0
        raw, out, start = _numbers(data, np.uint8), [], 0
        for end, (own, _), rows in zip(ends.tolist(), keys, copies):
            edge = np.flatnonzero(np.diff(gone[start:end], prepend=False, append=False)).tolist()
            spans = [{"start": a, "stop": b} for a, b in zip(edge[::2], edge[1::2])]
            kept = raw[start:end][~gone[start:end]].tobytes()
            out += [(None if own == _NO_ID else own, end - start, end - start - len(kept), len(spans), spans, kept)] * len(rows)
            start = end + 1
        return _rows(out, kept_schema)

    pieces = texts.groupBy("batch").applyInArrow(pieces_of, _spark_schema(_PIECES))
    flags = pieces.groupBy("bucket").applyInArrow(flags_of, _spark_schema(_FLAGS))
    strings = texts.groupBy("batch").cogroup(flags.groupBy("batch")).applyInArrow(strings_of, _spark_schema(_STRINGS))
    strings = staged(strings, "repeats")
    found = strings.where("bucket >= 0").groupBy("bucket").applyInArrow(spans_of, _spark_schema(_SPANS))

    def own_spans(tables: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in tables:
            sizes = [_numbers(s, np.uint16).astype(np.int64) for s in table["lengths"].to_pylist()]
            starts = [_widened(p, len(s)) for p, s in zip(table["places"].to_pylist(), sizes)]
            columns = [pa.array([c.tobytes() for c in cs], pa.binary()) for cs in (starts, [a + s for a, s in zip(starts, sizes)])]
            yield pa.record_batch([table["batch"], *columns], schema=_SPANS)

    local = strings.where("bucket < 0").select("batch", "places", "lengths").mapInArrow(own_spans, _spark_schema(_SPANS))
    spans = found.unionByName(local)
    result = "id long, n_bytes long, n_removed long, n_spans long, spans array<struct<start: long, stop: long>>, kept binary"
    kept = texts.groupBy("batch").cogroup(spans.groupBy("batch")).applyInArrow(kept_of, result)
    return kept.withColumnRenamed("id", id_column)
