"""Token ids of texts in Simple-8b files.

A 64-bit word holds a selector in its four highest bits and, below, as many ids
as the selector says, each in the selector's number of bits, the first lowest.
Selector 15 is the escape: its word is followed by the id, in a word of its own.
Every document is a block that starts on a word, with its number of ids and its
offsets in ids and in words from the beginning of its part, so that blocks are
decoded by themselves, a selector's words at a time. Blocks are rows of Parquet
files in ascending doc_id order: Spark's commit of whole files makes lost
executors harmless, and any store that Spark reaches will do.
"""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quillon.session import scratch_dir

# How many ids of how many bits fit into 60 bits, by selector.
PACKING = ((60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6), (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60))
ESCAPE = 15
#: Texts of so many bytes together are encoded at once.
TEXTS = 4_000_000
#: Blocks of so many ids together are packed or decoded at once.
CHUNK = 1_000_000
#: Pieces of text whose ids a worker keeps at most.
CACHE = 1_000_000
#: Bytes of the longest piece that is kept.
LONG = 64
#: Bytes of input, as the planner estimates them, that a part holds about.
PART_BYTES = 64 << 20


#: PACKING is by ascending width; an id below the n-th of these fits into the n-th width.
_LIMITS = np.array([1 << w for _, w in PACKING], np.uint64)
_COUNTS = np.array([c for c, _ in PACKING] + [0] * (ESCAPE - len(PACKING)) + [1], np.int64)


_WIDTHS = np.searchsorted(_LIMITS, np.arange(1 << 16, dtype=np.uint64), side="right").astype(np.int8)


def _widths(v: np.ndarray) -> np.ndarray:
    """Of each id, the place in PACKING of the least width that it fits into."""
    out = _WIDTHS[(v & np.uint64(0xFFFF)).astype(np.uint16)]
    large = np.flatnonzero(v >> np.uint64(16))
    out[large] = np.searchsorted(_LIMITS, v[large], side="right")
    return out


def _choices(narrow: np.ndarray) -> np.ndarray:
    """The best selector for a word that begins at each place: the first of PACKING whose count of next ids all fit."""
    most = {1: narrow}  # by power of two: the widest of so many ids from a place on
    size = 1
    while size * 2 <= PACKING[0][0]:
        most[size * 2] = np.maximum(most[size], np.append(most[size][size:], most[size][:size] * 0)[: len(narrow)])
        size *= 2
    choice = np.full(len(narrow), ESCAPE, np.int8)
    for rank in range(len(PACKING) - 1, -1, -1):
        count = PACKING[rank][0]
        half = most[1 << (count.bit_length() - 1)]
        rest = count - (1 << (count.bit_length() - 1))
        fits = half <= rank
        if rest:
            fits[: len(half) - rest] &= half[rest:] <= rank
        choice[fits] = rank
    return choice


def encode_blocks(ids: np.ndarray, ends: np.ndarray) -> list[bytes]:
    """A block of little-endian 64-bit words for each stretch of ids up to the next of ends. Ids are below 2**64.

    Greedy: each word takes the selector that holds most of the next ids; a
    block's last word may hold fewer than its selector says, the decoder knowing
    the number. Selectors are found for all places at once, with room after each
    block in which anything fits; only the steps from word to word are one after
    the other.
    """
    v = np.ascontiguousarray(ids, dtype=np.uint64)
    n, room = len(v), PACKING[0][0]
    if not n:
        return [b""] * len(ends)
    sizes = np.diff(ends, prepend=0)
    sizes, stops = sizes[sizes > 0], ends[sizes > 0]
    shift = np.repeat(np.arange(len(sizes)) * room, sizes)  # from a place among the ids to one with room
    wide = np.zeros(n + len(sizes) * room, np.int8)
    wide[np.arange(n) + shift] = _widths(v)
    choice = _choices(wide)
    step = _COUNTS.astype(np.uint8)[choice]
    after = stops + np.arange(1, len(sizes) + 1) * room  # where the next block begins
    gap = (np.arange(room) - room + after[:, None]).ravel()
    step[gap] = np.repeat(after, room) - gap
    starts, at, steps, total = [], 0, step.tobytes(), len(step)
    add = starts.append
    while at < total:
        add(at)
        at += steps[at]
    begin = np.array(starts)
    block = np.searchsorted(after, begin, side="right")
    begin, real = begin - block * room, begin - block * room < stops[block]
    chosen = choice[np.array(starts)[real]]
    begin, block = begin[real], block[real]
    held_by = np.minimum(_COUNTS[chosen], stops[block] - begin)
    size = 1 + (chosen == ESCAPE)
    place = np.cumsum(size) - size
    out = np.zeros(int(size.sum()), np.uint64)
    out[place] = chosen.astype(np.uint64) << np.uint64(60)
    for selector in np.unique(chosen):
        mine = np.flatnonzero(chosen == selector)
        if selector == ESCAPE:
            out[place[mine] + 1] = v[begin[mine]]
            continue
        count, width = PACKING[selector]
        held = held_by[mine]
        for k in range(count):
            full = mine if k == 0 else mine[held > k]
            out[place[full]] |= v[begin[full] + k] << np.uint64(k * width)
    data = out.astype("<u8").tobytes()
    cut = np.concatenate((place, [len(out)]))[np.searchsorted(begin, np.concatenate(([0], ends)))] * 8
    return [data[x:y] for x, y in zip(cut[:-1], cut[1:], strict=True)]


def decode_blocks(blocks: list[bytes], counts: list[int]) -> np.ndarray:
    """The ids of the blocks one after the other, counts[i] of block i; all words of a selector at a time."""
    words = np.frombuffer(b"".join(blocks), "<u8").astype(np.uint64)
    if not len(words):
        return np.zeros(0, np.uint64)
    selector = (words >> np.uint64(60)).astype(np.int8)
    literal = np.zeros(len(words), bool)
    after = -1
    for i in np.flatnonzero(selector == ESCAPE).tolist():  # the next word is an id, whatever its highest bits look like
        if i != after:
            after = i + 1
            literal[after] = True
    held = _COUNTS[selector]
    held[literal] = 0
    # The last words of blocks hold what their blocks' numbers leave for them.
    last_word = np.cumsum([len(b) // 8 for b in blocks])
    total = np.cumsum(held)
    want = np.cumsum(np.asarray(counts, np.int64))
    surplus = np.diff(total[np.maximum(last_word - 1, 0)] * (last_word > 0), prepend=0) - np.diff(want, prepend=0)
    filled = np.array([len(b) > 0 for b in blocks])
    tail = last_word[filled] - 1
    tail = np.where(literal[tail], tail - 1, tail)
    held[tail] -= surplus[filled]
    end = np.cumsum(held)
    out = np.zeros(int(end[-1]), np.uint64)
    for s in np.unique(selector[~literal]):
        mine = np.flatnonzero((selector == s) & ~literal)
        if s == ESCAPE:
            out[end[mine] - 1] = words[mine + 1]
            continue
        count, width = PACKING[s]
        begin, mask = end[mine] - held[mine], np.uint64((1 << width) - 1)
        for k in range(count):
            full = held[mine] > k
            out[begin[full] + k] = (words[mine[full]] >> np.uint64(k * width)) & mask
    return out


def encode(ids: np.ndarray) -> bytes:
    return encode_blocks(ids, np.array([len(ids)]))[0]


def decode(data: bytes, n: int) -> np.ndarray:
    return decode_blocks([data], [n])


# A piece is a run that the vocabulary's own pattern always cuts at both ends: letters with the space before them where
# only marks follow up to white space, those marks, any other run up to white space, or white space before such a run.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_MARKS = "!#$%&*+,-./:;=?@^_|~()"
#: White space other than space and line feed runs over pieces; such texts are encoded whole, as are those with a special token.
WHOLE = (*(c for c in map(chr, range(0x3001)) if c.isspace() and c not in " \n"), "<|endoftext|>")

_SPACE, _LETTER, _MARK, _OTHER = range(4)
#: Kinds of bytes. The first byte of a character of two is here for most of those that 0xC3 begins, which are letters but for × and ÷.
_KINDS = np.full(256, _OTHER, np.uint8)
_KINDS[np.frombuffer(b" \n", np.uint8)] = _SPACE
_KINDS[np.frombuffer(_MARKS.encode(), np.uint8)] = _MARK
_KINDS[[*range(65, 91), *range(97, 123), 0xC3]] = _LETTER


def piece_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where in the bytes of texts, of which each begins and ends at offsets, a piece begins."""
    if not len(data):
        return np.zeros(0, np.int64)
    kind = _KINDS[data]
    lead = np.flatnonzero(data == 0xC3)
    sign = (data[lead + 1] & 0xDF) == 0x97
    kind[lead + 1] = _LETTER
    kind[lead[sign]] = kind[lead[sign] + 1] = _OTHER
    begins = np.zeros(len(data) + 1, bool)
    begins[offsets] = True
    # Runs of one kind; a word is one or more runs between white space or ends of texts.
    run = np.flatnonzero(np.concatenate([[True], (kind[1:] != kind[:-1]) | begins[1:-1]]))
    of, first = kind[run], begins[run]
    space, end = of == _SPACE, np.append(run[1:], len(data))
    last = np.append(first[1:] | space[1:], True)  # white space or the end of the text comes next
    opens = first | np.append(True, space[:-1])
    split = np.zeros(len(run), bool)
    split[1:] = (of[1:] == _MARK) & last[1:] & ~first[1:] & (of[:-1] == _LETTER) & opens[:-1]
    # The last of the white space before a word is a piece, or the beginning of one if it is a space.
    before = np.flatnonzero(space & ~np.append(first[1:], True))
    feeds = before[data[end[before] - 1] != ord(" ")]
    begins[run[space]] = True
    begins[end[before] - 1] = True
    begins[end[feeds]] = True
    begins[run[split]] = True
    begins[-1] = False
    return np.flatnonzero(begins)


class _Known:
    """A tokenizer and the ids of pieces that it has had: number n of them has sizes[n] ids from starts[n] on."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.number: dict[bytes, int] = {}
        self.ids, self.starts, self.sizes, self.n_ids = np.zeros(1 << 16, np.uint32), np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int64), 0
        feed = self.tokenizer.encode("\n", add_special_tokens=False).ids
        self.feed = feed[0] if len(feed) == 1 else None

    def whole(self, texts: list[bytes]) -> list[np.ndarray]:
        return [np.array(e.ids, np.uint32) for e in self.tokenizer.encode_batch_fast([t.decode() for t in texts], add_special_tokens=False)]

    def lines(self, pieces: list[bytes]) -> list[np.ndarray] | None:
        """Of pieces without line feeds and not of spaces alone, all in one call: a feed between two is cut and encoded by itself."""
        ids = self.whole([b"\n".join(pieces)])[0]
        cut = np.flatnonzero(ids == self.feed)
        if len(cut) != len(pieces) - 1:
            return None
        return [ids[a:b] for a, b in zip([0, *(cut + 1).tolist()], [*cut.tolist(), len(ids)], strict=True)]

    def add(self, coded: list[np.ndarray]) -> None:
        """Ids of the pieces from number len(self.number) on."""
        flat, n, size = np.concatenate(coded), len(self.number), np.fromiter(map(len, coded), np.int64, len(coded))
        if self.n_ids + len(flat) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(max(len(self.ids), len(flat)), np.uint32)])
        if n + len(size) > len(self.starts):
            more = np.zeros(max(len(self.starts), len(size)), np.int64)
            self.starts, self.sizes = np.concatenate([self.starts, more]), np.concatenate([self.sizes, more])
        self.ids[self.n_ids : self.n_ids + len(flat)] = flat
        self.starts[n : n + len(size)] = self.n_ids + np.cumsum(size) - size
        self.sizes[n : n + len(size)] = size
        self.n_ids += len(flat)


#: By vocabulary file; a worker that is used again finds pieces known.
_LOADED: dict[str, _Known] = {}


class Encoder:
    """ids of texts with the tokenizers library; ids of pieces that come again are kept."""

    def __init__(self, path: str) -> None:
        if path not in _LOADED:
            _LOADED[path] = _Known(path)
        self.known = _LOADED[path]
        self.tokenizer = self.known.tokenizer

    def _numbers(self, pieces: list[bytes], odd: set[bytes]) -> tuple[np.ndarray, int]:
        """Numbers of different pieces, odd ones being whole texts, and how many numbers stay: the caller gives up the later ones."""
        known = self.known
        numbers = np.fromiter(map(known.number.get, pieces, itertools.repeat(-1)), np.int64, len(pieces))
        new = np.flatnonzero(numbers < 0)
        if not len(new):
            return numbers, len(known.number)
        alone = [p in odd or b"\n" in p or not p.strip(b" ") or len(p) > LONG for p in map(pieces.__getitem__, new.tolist())]
        alone = np.array(alone) | (known.feed is None)
        plain, rest = new[~alone], new[alone]
        coded = known.lines([pieces[i] for i in plain.tolist()]) if len(plain) else []
        if coded is None:
            plain, rest, coded = new[:0], new, []
        if len(rest):
            coded += known.whole([pieces[i] for i in rest.tolist()])
        known.add(coded)
        stay, n = len(known.number), len(known.number)
        numbers[plain] = np.arange(n, n + len(plain))
        numbers[rest] = np.arange(n + len(plain), n + len(coded))
        if n + len(plain) <= CACHE:  # else the newest go, most of which are rare
            known.number.update(zip([pieces[i] for i in plain.tolist()], range(n, n + len(plain)), strict=True))
            stay += len(plain)
        return numbers, stay

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and where among them each text's ids end."""
        texts = texts.cast(pa.string()).fill_null("")
        offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
        base = int(offsets[0])
        raw = (texts.buffers()[2] or pa.py_buffer(b""))[base : int(offsets[-1])]
        offsets -= base
        start, text = piece_starts(np.frombuffer(raw, np.uint8), offsets), str(raw, "utf-8")
        odd: set[bytes] = set()
        if any(x in text for x in WHOLE):
            whole = np.array([any(x in t for x in WHOLE) for t in texts.to_pylist()])
            of = np.searchsorted(offsets, start, side="right") - 1
            start = start[~whole[of] | (start == offsets[of])]
            odd = {t.encode() for t in texts.filter(pa.array(whole)).to_pylist()}
        if not len(start):
            return np.zeros(0, np.uint32), np.zeros(len(texts), np.int64)
        bounds = np.append(start, len(raw)).astype(np.int32)
        coded = pa.Array.from_buffers(pa.binary(), len(start), [None, pa.py_buffer(bounds), raw]).dictionary_encode()
        known = self.known
        different = coded.dictionary
        bounds = np.frombuffer(different.buffers()[1], np.int32)[: len(different) + 1].tolist()
        flat = different.buffers()[2].to_pybytes()
        numbers, stay = self._numbers([flat[a:b] for a, b in itertools.pairwise(bounds)], odd)
        number = numbers[coded.indices.to_numpy()]
        size = known.sizes[number]
        stop = np.cumsum(size)
        ids = known.ids[np.repeat(known.starts[number] - stop + size, size) + np.arange(stop[-1])]
        known.n_ids = int(known.starts[stay - 1] + known.sizes[stay - 1]) if stay else 0
        return ids, np.append(0, stop)[np.searchsorted(start, offsets[1:])]

    def __call__(self, texts: list[str]) -> list[bytes]:
        ids, ends = self.encode(pa.array(texts, pa.string()))
        data, ends = ids.astype("<u4").tobytes(), (ends * 4).tolist()
        return [data[x:y] for x, y in zip([0, *ends[:-1]], ends, strict=True)]


def _stop(ends: np.ndarray, at: int, most: int) -> int:
    """The end of the rows from at on that have most together, or one row; ends has what comes before each row, and the sum."""
    return max(at + 1, int(np.searchsorted(ends, ends[at] + most, side="right")) - 1)


def _parts(docs: DataFrame) -> int:
    """As many as the session's shuffles have, or more where parts would be larger than PART_BYTES."""
    estimate = int(str(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(-(-estimate // PART_BYTES), 1 << 20))


_FILE = "part int, doc_id {}, n_tokens long, first_id long, first_word long, block binary"


def write(docs: DataFrame, path: str, tokenizer: str, end_id: int = 0) -> None:
    """Token files of all documents at path, by ascending doc_id.

    Rows: part, doc_id, n_tokens with the end id, first_id and first_word (ids and
    words of the part before the block), and block. Documents are dealt by ranges
    of doc_id, so that parts follow one another; null doc_ids come first, and rows
    with one doc_id stand by their texts.
    """
    order = (F.asc_nulls_first("doc_id"), F.asc_nulls_first("text"))
    ordered = docs.select("doc_id", "text").repartitionByRange(_parts(docs), order[0]).sortWithinPartitions(*order)
    ordered = ordered.select("doc_id", "text", F.spark_partition_id().alias("part"))
    id_type = ordered.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer)
        first_id = first_word = 0
        for batch in batches:
            length = np.append(0, np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False), dtype=np.int64))
            at = 0
            while at < batch.num_rows:
                stop = _stop(length, at, TEXTS)
                ids, ends = encoder.encode(batch.column(1)[at:stop])
                ids, ends = np.insert(ids, ends, end_id), np.append(0, ends + np.arange(1, stop - at + 1))
                done = 0
                while done < stop - at:
                    to = _stop(ends, done, CHUNK)
                    mine = slice(at + done, at + to)
                    counts = np.diff(ends[done : to + 1])
                    blocks = encode_blocks(ids[ends[done] : ends[to]], np.cumsum(counts))
                    sizes = np.fromiter((len(b) // 8 for b in blocks), np.int64, len(blocks))
                    before, words = ends[done:to] - ends[done], np.cumsum(sizes)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(2)[mine].cast(pa.int32()), batch.column(0)[mine], pa.array(counts), pa.array(first_id + before), pa.array(first_word + words - sizes), pa.array(blocks, pa.binary())],
                        names=["part", "doc_id", "n_tokens", "first_id", "first_word", "block"],
                    )
                    first_id += int(counts.sum())
                    first_word += int(words[-1])
                    done = to
                at = stop

    ordered.mapInArrow(run, _FILE.format(id_type)).write.option("compression", "zstd").parquet(path)


def read(docs: DataFrame, path: str) -> DataFrame:
    """From the files at path: doc_id, start (ids before the document), n_tokens and ids_crc32. docs gives the type of doc_id.

    A block's offset within its part and the sizes of the parts before it give its start.
    """
    id_type = docs.schema["doc_id"].dataType.simpleString()
    files = docs.sparkSession.read.schema(_FILE.format(id_type)).parquet(path)
    sizes = files.groupBy("part").agg(F.sum("n_tokens").alias("_sum"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each part
    bases = sizes.select("part", F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_base"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, crc, at = batch.column(2).to_pylist(), [], 0
            while at < len(n):
                stop, ids = at, 0
                while stop < len(n) and (stop == at or ids + n[stop] <= CHUNK):
                    ids += n[stop]
                    stop += 1
                data = memoryview(decode_blocks(batch.column(4)[at:stop].to_pylist(), n[at:stop]).astype("<u4")).cast("B")
                place = 0
                for k in n[at:stop]:
                    crc.append(zlib.crc32(data[place : place + 4 * k]))
                    place += 4 * k
                at = stop
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(crc, pa.int64())], names=["part", "doc_id", "n_tokens", "first_id", "ids_crc32"])

    slim = files.select("part", "doc_id", "n_tokens", "first_id", "block")
    checked = slim.mapInArrow(run, f"part int, doc_id {id_type}, n_tokens long, first_id long, ids_crc32 long")
    return checked.join(bases, "part").select("doc_id", (F.col("_base") + F.col("first_id")).alias("start"), "n_tokens", "ids_crc32")


def tokenise(docs: DataFrame, tokenizer: str | None = None, path: str | None = None, end_id: int = 0) -> DataFrame:
    """Writes the token files of docs and reads them back: doc_id, start, n_tokens and ids_crc32 of each row.

    docs needs doc_id and text; other columns are ignored. A null or empty text
    is the end id alone. Repeated rows are written as often as they come. An
    empty table gives no rows. The tokenizer is a vocabulary file of the
    tokenizers library, at the same path on all executors; files go to path, or
    to the shared scratch folder.
    """
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    path = path or scratch_dir(docs.sparkSession)
    write(docs, path, tokenizer, end_id)
    return read(docs, path)
