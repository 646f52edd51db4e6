"""Alignment of two tokenizers' tokens over the same bytes.

Each text is encoded by A (a byte-level BPE of `tokenizers`, of a space and the
text) and by B (a `sentencepiece` model with byte fallback, which adds that
space itself). The tokenizers' own spans are coarse cuts: A's character offsets
and the spans of B's proto say where a token ends between two characters. Where
characters are split over tokens (several bytes of one character, byte-fallback
pieces) the ends in between come from the tokens' decoded bytes, and the next
coarse cut has to agree with their sum. Byte offsets where a token of A and one
of B both end cut the tokens into groups. (The installed sentencepiece gives the
proto's spans as `offset_mapping`; its `immutable_proto` form is gone.)

A text is aligned in units: neither tokenizer has a token over a single space
between two printable characters (A splits there before it merges, and no piece
of B has a space behind another character; both are checked when the files are
loaded, else a text is one unit). Nor has any a token over a letter and a mark
behind it, or over a line's end, so a word is cut there once more: `word`, `,`
and a line's first word are parts of their own, and the different words of many
texts have far fewer different parts. Each different part is encoded once a task
(as long as it is remembered), and a text's tokens and groups are those of its
parts in order.

How often A's and B's ids are linked is counted over all documents. A task writes
chunks of whole documents (their parts, and the links of each different part);
the counts of all id pairs are a Spark aggregation of the chunks' own counts and
go back to the chunks by a join, as lists no longer than a chunk's own pairs.

A chunk crosses compressed and cut into pieces, rows far smaller than the JVM's
regions for large arrays, and is put together again where its counts are: one
chunk at a time, however many fall to a task. What a task has freed goes back to
the machine when it ends, so that idle Python workers hold little beside the JVM.

Defined results: null and empty texts, and texts whose tokens do not spell a space
and the text in A or in B (B reads U+2581 as a space, so texts that hold it), have
no tokens: numbers are 0 and `groups` is ''. Rows with a null id and repeated rows
are rows as any other and count each; an empty table gives no rows. Only id and
text are read, so other columns may have any name. Very long texts are one row of
one chunk; a text without single spaces is one unit.
"""

from __future__ import annotations

import ctypes
import json
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import documents, write_scratch

TOKENIZERS = "/opt/tokenizers"  # on every node
FILE_A, FILE_B = "byte_bpe_50k.json", "piece_bpe_32k.model"
CHUNK_UNITS = 1 << 19  # words of a chunk; different words, their parts and documents count more
PIECE = 1 << 17  # bytes of a row of a chunk
BLOCK = 8 << 20  # bytes of chunks that a writer holds, and a reader reads at a time, once 100 rows are there
KEPT = 80_000  # different parts that a task remembers, and as many older ones
LONGEST = 64  # characters of a part that is remembered
TOGETHER = 1 << 18  # bytes of texts whose units are looked up together
SHIFT = 24  # an id pair is a << SHIFT | b
BEHIND = "\x00"  # before a part that stands behind a letter or a mark; no unit begins with it
_LETTER, _MARK = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f", r"!-&(-/:-@\[-`{-~"  # an apostrophe joins letters in A
_CUT = re.compile(f"(?<=[{_LETTER}])(?=[{_MARK}])|(?<=[{_LETTER}{_MARK}])(?=\n)")
_CROSSED = re.compile(f"[{_LETTER}][{_MARK}]|\n")


def _byte_alphabet() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable Latin-1 stands for itself, the rest follow from U+0100 on."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 255 and b != 173]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Aligner:
    """Both tokenizers, their tokens' bytes, and the alignment of single units."""

    def __init__(self, file_a: str, file_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        import tokenizers

        self.a = tokenizers.Tokenizer.from_file(file_a)
        self.a.encode_special_tokens = True
        byte = _byte_alphabet()
        self.bytes_a = {i: bytes(byte[c] for c in t) if all(c in byte for c in t) else t.encode()
                        for t, i in self.a.get_vocab(with_added_tokens=True).items()}
        self.b = b = sentencepiece.SentencePieceProcessor(model_file=file_b)
        pieces = [b.id_to_piece(i) for i in range(b.get_piece_size())]
        self.bytes_b = [bytes([int(p[1:-1], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        split = json.loads(self.a.pre_tokenizer.__getstate__()) if self.a.pre_tokenizer else {}  # the file's own words for it
        size = lambda parts: np.array([len(p) for p in parts], np.int64)
        self.size_a, self.size_b = size(map(self.bytes_a.__getitem__, range(1 + max(self.bytes_a)))), size(self.bytes_b)
        first = split.get("type") == "ByteLevel" and split.get("use_regex") and not split.get("add_prefix_space")
        self.by_unit = bool(first) and not any("▁" in p.lstrip("▁") for p in pieces)
        self.by_part = self.by_unit and not any(_CROSSED.search(p) for i, p in enumerate(pieces) if not (b.is_byte(i) or b.is_control(i) or b.is_unknown(i)))

    def split(self, text: str) -> list[str]:
        """The text between its spaces; these are its units if all of them are `free`."""
        return text.split(" ") if self.by_unit else [text]

    def free(self, part: str) -> bool:
        """Whether a stretch between spaces may be encoded wherever it stands, beside others that may."""
        return self.by_unit and bool(part) and part[0].isprintable() and part[-1].isprintable()

    def units(self, text: str) -> list[str]:
        """The text's units, each without its leading space if it may be encoded wherever it stands."""
        out, held = [], []
        for part in self.split(text):
            ok = self.free(part)
            # Both sides of the space before a unit have to be printable.
            if held and ok and held[-1][1]:
                out.append(self._unit(held))
                held = []
            held.append((part, ok))
        out.append(self._unit(held))
        return out

    @staticmethod
    def _unit(held: list[tuple[str, bool]]) -> str:
        return held[0][0] if len(held) == 1 and held[0][1] else " " + " ".join(p for p, _ in held)

    def parts(self, unit: str) -> list[str]:
        """The stretches of a unit that no token of A or B crosses; those behind its first are marked."""
        if not self.by_part or unit.isalpha() or unit.startswith(" "):
            return [unit]
        first, *rest = _CUT.split(unit)
        return [first, *(BEHIND + p for p in rest)]

    def align(self, units: list[str]) -> list[tuple]:
        """(n_a, n_b, n_groups, groups, links as bytes of id pairs) of each unit or part; n_a is -1 where the tokens do not spell it.

        Units that may stand anywhere are encoded as one text, as neither tokenizer
        joins them; the others one by one. One pass of array operations aligns them all.
        A part that stands behind a letter is encoded behind one.
        """
        texts, wanted = [], []
        for u in units:
            if u.startswith(BEHIND):
                texts.append(" x")
            texts.append(u[1:] if u.startswith(BEHIND) else u if u.startswith(" ") else " " + u)
            wanted.append(len(texts) - 1)
        whole = "".join(texts)
        lengths = [len(t) for t in texts] if any(u.startswith(" ") for u in units) else [len(whole)]
        first = np.cumsum([0, *lengths])  # the encoded texts' first characters
        asked = [whole[lo:lo + n] for lo, n in zip(first.tolist(), lengths)]
        plain = whole.isascii()
        got_a = (self.a.encode_batch_fast if plain else self.a.encode_batch)(asked, add_special_tokens=False)
        ids_a, spans_a, spans_b = [e.ids for e in got_a], None, None
        if plain:
            # A token's span is its bytes.
            ids_b = self.b.encode([t[1:] for t in asked], num_threads=1)
        else:
            got_b = self.b.encode([t[1:] for t in asked], return_type="offset_mapping", num_threads=1)
            ids_b, spans_a, spans_b = [e["ids"] for e in got_b], [e.offsets for e in got_a], [e["offsets"] for e in got_b]
        body = whole.encode()
        if not all(b"".join(map(part.__getitem__, chain.from_iterable(ids))) == body for part, ids in ((self.bytes_a, ids_a), (self.bytes_b, ids_b))):
            if len(units) == 1:
                return [(-1, 0, 0, "", b"")]
            half = len(units) // 2
            return self.align(units[:half]) + self.align(units[half:])
        body = np.frombuffer(body, np.uint8)
        at = np.append(np.flatnonzero(body & 0xC0 != 0x80), len(body))  # byte offset of each character
        a, ends_a = _ends(ids_a, spans_a, self.size_a, at, first, 0)
        b, ends_b = _ends(ids_b, spans_b, self.size_b, at, first, 1)
        # A stretch between neighbouring ends lies in one token of A and one of B: that is a link.
        stops = np.union1d(ends_a, ends_b)
        links = a[np.searchsorted(ends_a, stops)] << SHIFT | b[np.searchsorted(ends_b, stops)]
        cuts = np.intersect1d(ends_a, ends_b, assume_unique=True)
        upto = at[np.cumsum(list(map(len, texts)))]  # a unit's last byte is a cut
        groups = self._groups(a, np.searchsorted(cuts, ends_a), b, np.searchsorted(cuts, ends_b), np.searchsorted(cuts, upto))
        n_a, n_b, n_groups, last = (np.searchsorted(x, upto, "right") for x in (ends_a, ends_b, cuts, stops))
        data, last = links.tobytes(), (8 * last).tolist()
        n_a, n_b, n_groups = (np.diff(x, prepend=0).tolist() for x in (n_a, n_b, n_groups))
        last = [0, *last]
        return [(n_a[i], n_b[i], n_groups[i], groups[i], data[last[i]:last[i + 1]]) for i in wanted]

    def _groups(self, a, group_a, b, group_b, last) -> list[str]:
        """`a1,a2|b1;a3|b2` of each unit; `last` is each unit's last group."""
        group = np.concatenate((group_a, group_b))
        side = np.repeat((0, 1), (len(a), len(b)))
        order = np.argsort(2 * group + side, kind="stable")
        group, side = group[order], side[order]
        sign = np.full(len(order), 0)  # what follows the id: a comma, a bar between the sides, a semicolon, the unit's end
        sign[:-1] = np.where(group[1:] != group[:-1], 2, side[1:] != side[:-1])
        sign[np.searchsorted(group, last, "right") - 1] = 3
        number = np.concatenate((a, b))[order]
        text = "".join([x for pair in zip(map(str, number.tolist()), map(",|;\n".__getitem__, sign.tolist())) for x in pair])
        return text.split("\n")[:-1]


def _ends(ids: list[list[int]], spans: list, sizes: np.ndarray, at: np.ndarray, first: np.ndarray, shift: int):
    """(ids, byte offsets at which the tokens end) over all encoded texts, laid end to end from characters `first` on.

    `spans` are characters of each text without its first `shift`. A span that is not
    empty and does not reach into its text's next one ends at a coarse cut; other
    tokens end their decoded bytes behind the last cut, and those bytes have to add up.
    Without spans (texts of ASCII only) every token is cut by its bytes.
    """
    count = [len(x) for x in ids]
    flat = np.fromiter(chain.from_iterable(ids), np.int64, sum(count))
    if spans is None:
        return flat, np.cumsum(sizes[flat])
    lo, hi = np.fromiter(chain.from_iterable(chain.from_iterable(spans)), np.int64, 2 * len(flat)).reshape(-1, 2).T
    base = np.repeat(first[:-1] + shift, count)
    ends = np.cumsum(sizes[flat])
    text_end = np.zeros(len(flat), bool)
    text_end[np.cumsum(count) - 1] = True
    coarse = (hi > lo) & (text_end | np.append(lo[1:] >= hi[:-1], True))
    if (at[(base + hi)[coarse]] != ends[coarse]).any():
        raise ValueError("the tokens' spans and their bytes disagree")
    return flat, ends


CHUNK = "chunk bigint, piece int, n_a array<int>, data binary, pairs array<bigint>, pair_n array<bigint>"
ALIGNED = ("doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups string")


def _narrow(x: np.ndarray, top: int) -> np.ndarray:
    return x.astype(np.uint16 if top <= 1 << 16 else np.uint32)


def _planes(x: np.ndarray, top: int) -> bytes:
    """All lowest bytes, then all next ones, as many as numbers below `top` have: high bytes compress well by themselves."""
    width = max(1, (max(top - 1, 0).bit_length() + 7) // 8)
    return x.astype("<u4").view(np.uint8).reshape(-1, 4)[:, :width].T.tobytes()


def _numbers(planes: bytes, n: int) -> np.ndarray:
    out = np.zeros((n, 4), np.uint8)
    if n:
        at = np.frombuffer(planes, np.uint8).reshape(-1, n)
        out[:, :len(at)] = at.T
    return out.reshape(-1).view("<u4")


def _pieces(columns: dict[str, pa.Array]) -> list[bytes]:
    """Columns, each one row, as a compressed Arrow stream cut into pieces: a chunk is written, shuffled and read whole."""
    sink, batch = pa.BufferOutputStream(), pa.RecordBatch.from_pydict(columns)
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=3), use_threads=False)) as out:
        out.write_batch(batch)
    data = sink.getvalue().to_pybytes()
    return [data[lo:lo + PIECE] for lo in range(0, len(data), PIECE)]


def _columns(pieces: list[bytes]) -> dict[str, pa.Scalar]:
    with pa.ipc.open_stream(pa.py_buffer(b"".join(pieces)), options=pa.ipc.IpcReadOptions(use_threads=False)) as data:
        batch = data.read_next_batch()
    return {name: batch.column(k)[0] for k, name in enumerate(batch.schema.names)}


def _give_back() -> None:
    """Freed memory of this Python worker goes back to the machine."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


class _Chunks:
    """Collects documents of one task into chunk rows."""

    def __init__(self, aligner: Aligner):
        self.aligner, self.memo, self.older = aligner, {}, {}
        self.number = TaskContext.get().partitionId() << 32
        self._clear()

    def _clear(self):
        self.ids, self.docs, self.size = [], [], 0
        self.words, self.parts, self.n_parts = {}, [], []  # a word's number, and the parts of all words, end to end
        self.local, self.rows = {}, []
        self.bad: set[int] = set()  # words of this chunk that their tokens do not spell

    def add(self, ids: list, texts: list[str | None]) -> None:
        split = [self.aligner.split(t) if t else [] for t in texts]
        new = {p for words in split for p in words if p not in self.words}
        fixed = {p for p in new if not self.aligner.free(p)}
        if fixed:
            for i, words in enumerate(split):
                if not fixed.isdisjoint(words):
                    split[i] = self.aligner.units(texts[i])
            new = {p for words in split for p in words if p not in self.words}
        self._learn(sorted(new))
        for doc_id, words in zip(ids, split):
            at = np.fromiter(map(self.words.__getitem__, words), np.uint32, len(words))
            if self.bad and not self.bad.isdisjoint(at.tolist()):
                at = at[:0]  # tokens that do not spell the text
            self.ids.append(doc_id)
            self.docs.append(at)
            self.size += len(at)

    def _learn(self, new: list[str]) -> None:
        cut = [self.aligner.parts(u) for u in new]
        parts = dict.fromkeys(p for u in cut for p in u if p not in self.local)
        known, ask = {}, []
        for p in parts:
            row = self.memo.get(p) or self.older.get(p)
            if row is None:
                ask.append(p)
            else:
                known[p] = row
        # Parts of one kind together: those that may stand anywhere are encoded as one text.
        ascii = [p for p in ask if p.isascii() and not p.startswith(" ")]
        other = [p for p in ask if not p.isascii() and not p.startswith(" ")]
        for part in (ascii, other, [p for p in ask if p.startswith(" ")]):
            for lo in range(0, len(part), 4096):
                known.update(zip(part[lo:lo + 4096], self.aligner.align(part[lo:lo + 4096])))
        for p in parts:
            self.local[p] = len(self.rows)
            self.rows.append(known[p])
        for u, own in zip(new, cut):
            own = [self.local[p] for p in own]
            if any(self.rows[i][0] < 0 for i in own):
                self.bad.add(len(self.words))
            self.words[u] = len(self.words)
            self.parts += own
            self.n_parts.append(len(own))
        if len(self.memo) > KEPT:
            self.memo, self.older = {}, self.memo
        self.memo.update((p, r) for p, r in known.items() if len(p) <= LONGEST)

    def full(self, most: int) -> bool:
        """Documents, different words and their parts count too, so that no chunk holds any number of them."""
        return self.size + 8 * len(self.ids) + 2 * len(self.words) + 2 * len(self.rows) >= most

    def flush(self) -> dict | None:
        """The chunk's rows: pieces of its columns, and an even share each of its parts' `n_a` and of its pairs."""
        if not self.ids:
            return None
        words = np.concatenate([np.empty(0, np.uint32), *self.docs])
        n_parts, n_words = np.array(self.n_parts, np.int32), np.array([len(d) for d in self.docs], np.int64)
        each = n_parts[words]
        n_units = _sums(each, n_words)
        # A word's parts, one after another.
        at = np.repeat((np.cumsum(n_parts)[words] - np.cumsum(each)).astype(np.int32), each)
        at += np.arange(len(at), dtype=np.int32)
        units = np.array(self.parts, np.uint32)[at]
        del words, each, at
        # The more often a part stands in the chunk, the smaller its number.
        held = np.bincount(units, minlength=len(self.rows))
        order = np.argsort(-held, kind="stable")
        rank = np.empty(len(order), np.uint32)
        rank[order] = np.arange(len(order), dtype=np.uint32)
        rows, held, units = [self.rows[i] for i in order.tolist()], held[order], rank[units]
        links = np.frombuffer(b"".join([r[4] for r in rows]), np.int64)
        pairs, where = np.unique(links, return_inverse=True)
        n_links = np.array([len(r[4]) // 8 for r in rows], np.int32)
        pair_n = np.zeros(len(pairs), np.int64)
        np.add.at(pair_n, where, np.repeat(held, n_links))
        one = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), pa.array(x))
        field = lambda k: np.array([r[k] for r in rows], np.int32)
        pieces = _pieces({
            "ids": one(pa.array(self.ids, pa.int64())), "n_units": one(n_units), "units": pa.array([_planes(units, len(rows))]), "n_b": one(field(1)),
            "n_groups": one(field(2)), "groups": one(pa.array([r[3] for r in rows], pa.string())), "n_links": one(n_links),
            "links": one(_narrow(where, len(pairs))), "pairs": one(pairs)})
        n = len(pieces)
        out = {"chunk": [self.number] * n, "piece": range(n), "data": pieces} | {
            k: np.array_split(x, n) for k, x in (("n_a", field(0)), ("pairs", pairs), ("pair_n", pair_n))}
        self.number += 1
        self._clear()
        return out


_LOADED: dict[tuple[str, str], Aligner] = {}


def _aligner(file_a: str, file_b: str) -> Aligner:
    """One pair of tokenizers for each Python worker."""
    if (file_a, file_b) not in _LOADED:
        _LOADED[file_a, file_b] = Aligner(file_a, file_b)
    return _LOADED[file_a, file_b]


def _chunks(docs: DataFrame, file_a: str, file_b: str, chunk_units: int) -> DataFrame:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    arrow = to_arrow_schema(StructType.fromDDL(CHUNK))

    def chunk_rows(batches):
        chunks = _Chunks(_aligner(file_a, file_b))

        def rows():
            out = chunks.flush()
            _give_back()
            return [] if out is None else [pa.RecordBatch.from_arrays([pa.array(out[f.name], type=f.type) for f in arrow], schema=arrow)]

        for b in batches:
            ids, texts = (b.column(i) for i in (0, 1))
            n, sizes = b.num_rows, pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
            lo = 0
            while lo < n:
                hi = lo + max(1, int(np.searchsorted(np.cumsum(sizes[lo:]), TOGETHER)))
                chunks.add(ids[lo:hi].to_pylist(), texts[lo:hi].to_pylist())
                lo = hi
                if chunks.full(chunk_units):
                    yield from rows()
            del b, ids, texts  # before the next are read
        yield from rows()

    def run(batches):
        try:
            yield from chunk_rows(batches)
        finally:
            _give_back()

    return docs.select("doc_id", "text").mapInArrow(run, CHUNK)


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Exact sums of consecutive stretches of `values`."""
    upto = np.concatenate((np.zeros(1, np.int64), np.cumsum(values, dtype=np.int64)))
    ends = np.cumsum(sizes)
    return upto[ends] - upto[ends - sizes]


def _documents(chunk: dict[str, pa.Scalar], n_a: np.ndarray, counts: list[pa.StructArray]) -> Iterator[dict]:
    """The documents of one chunk; `n_a` is of its parts, `counts` has (pair, n, best) for each of its pairs."""
    as_array = lambda k: chunk[k].values.to_numpy(zero_copy_only=False)
    pairs, each, n_units, links = map(as_array, ("pairs", "n_links", "n_units", "links"))
    units = _numbers(chunk["units"].as_py(), int(n_units.sum()))
    n, best = np.zeros(len(pairs), np.int64), np.zeros(len(pairs), np.int64)
    for found in counts:
        pair, sums, tops = (x.to_numpy() for x in found.flatten())
        at = np.searchsorted(pairs, pair)
        n[at], best[at] = sums, tops
    unit = {"n_a": n_a, "n_b": as_array("n_b"), "n_groups": as_array("n_groups"), "n_links": each,
            "n_best": _sums(best[links], each), "count_sum": _sums(n[links], each)}
    doc = {k: _sums(v[units], n_units) for k, v in unit.items()}
    groups = chunk["groups"].values.to_numpy(zero_copy_only=False)
    ends, ids = np.cumsum(n_units), chunk["ids"].values
    lo = size = 0
    texts = []
    for i, end in enumerate(ends):
        texts.append(";".join(groups[units[end - n_units[i]:end]]))
        size += len(texts[-1])
        if size > 1 << 23 or i + 1 == len(ends):
            yield {"doc_id": ids[lo:i + 1], **{k: v[lo:i + 1] for k, v in doc.items()}, "groups": texts}
            lo, size, texts = i + 1, 0, []


def _put_together(rows: DataFrame) -> DataFrame:
    """The documents of all chunks, from their pieces and the counts of their pairs."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    arrow = to_arrow_schema(StructType.fromDDL(ALIGNED))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces, counts = {}, []
        for b in batches:
            for number, n_a, data, found in zip(*(b.column(k) for k in ("piece", "n_a", "data", "counts"))):
                if data.is_valid:
                    pieces[number.as_py()] = n_a.values.to_numpy(), data.as_py()
                elif found.is_valid:
                    counts.append(found.values)
        n_a, data = zip(*(pieces[k] for k in sorted(pieces)))
        del pieces
        for out in _documents(_columns(data), np.concatenate(n_a), counts):
            yield pa.RecordBatch.from_arrays([pa.array(out[f.name], type=f.type) for f in arrow], schema=arrow)

    return rows.groupBy("chunk").applyInArrow(run, ALIGNED)


def align(docs: DataFrame, file_a: str = f"{TOKENIZERS}/{FILE_A}", file_b: str = f"{TOKENIZERS}/{FILE_B}",
          chunk_units: int = CHUNK_UNITS) -> DataFrame:
    """One row a document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups.

    `groups` is `a1,a2|b1;a3|b2,b3`: the ids of A and B of each group. n_best counts
    the links whose corpus-wide count is the highest of their B id, count_sum adds
    up the links' counts. The files' paths hold on every node.
    """
    chunks = write_scratch(_chunks(docs, file_a, file_b, chunk_units), "align-chunks", **{"parquet.block.size": BLOCK})
    own = chunks.select("chunk", F.explode(F.arrays_zip("pairs", "pair_n")).alias("x")).select("chunk", F.col("x.pairs").alias("pair"), "x.pair_n")
    counts = own.groupBy("pair").agg(F.sum("pair_n").alias("n"))
    counts = write_scratch(counts, "align-counts")
    top = counts.groupBy(F.col("pair").bitwiseAND((1 << SHIFT) - 1).alias("b")).agg(F.max("n").alias("top"))
    counts = counts.withColumn("b", F.col("pair").bitwiseAND((1 << SHIFT) - 1)).join(top, "b").select(
        "pair", "n", (F.col("n") == F.col("top")).cast("int").alias("best"))
    back = own.select("chunk", "pair").join(counts, "pair").groupBy("chunk").agg(
        F.collect_list(F.struct("pair", "n", "best")).alias("counts"))  # as many as the chunk's own pairs
    return _put_together(chunks.select("chunk", "piece", "n_a", "data").unionByName(back, allowMissingColumns=True))


def op11_token_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = align(documents(spark, sf_dir))
    digest = F.when(F.col("groups") == "", F.lit("")).otherwise(F.sha2(F.col("groups"), 256))
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", digest.alias("groups_sha256"))
