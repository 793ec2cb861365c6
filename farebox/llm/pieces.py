"""SentencePiece encoding and decoding with offsets: every piece comes with the bytes of the text that it stands for.

1. **Normalise.** At each place of the text the longest rule of the model's compiled character map is applied, else a
   character is copied; spaces are put before, joined or cut off as the model says. For every byte that comes out, the
   place in the text it comes from is recorded. A model without rules copies the text, and places only move by the
   space that is put before it.
2. **Encode.** The normalised text is cut into words, a run of spaces with what follows. No piece holds a space after
   another character, so words are encoded apart, and those seen lately are kept. A word is merged pair by pair, best
   score first, with a heap, so a text of a single long word takes n log n steps. A character without a piece becomes
   byte pieces, of which the last stands for the character and the others for nothing.
3. **Project.** The sizes of the pieces add up to places in the normalised text, and its record leads to the original.

Spaces are kept as one byte here, where the model's pieces write a mark of three.

Defined cases: a null text is an empty one; an empty text has the begin and end ids only; special strings are ordinary
text; repeated rows and null ids are encoded row by row; an empty table gives no rows; other columns are not read.
Models other than byte-pair ones, with pieces of the user's own or unused ones, or with spaces as suffixes are refused.
"""

from __future__ import annotations

import hashlib
import heapq
import itertools
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farebox.llm.common import in_small_batches, utf8

MARK = "▁".encode()
REPLACEMENT = "�".encode()
UNKNOWN_TEXT = " ⁇ ".encode()
MOST_WORDS = 1_000_000
LONGEST_WORD = 64
SHORT = 64  # characters up to which a word is merged without a heap
NONE = float("-inf")  # the score of a pair without a piece

# Numbers of the fields and kinds in a model file, and the model type; fixed by the format.
PIECES, TRAINER, NORMALIZER = 1, 2, 3
MODEL_TYPE, SUFFIX_SPACES, BYTE_FALLBACK, UNK, BOS, EOS = 3, 24, 35, 40, 41, 42
CHARSMAP, DUMMY_PREFIX, REMOVE_SPACES, ESCAPE_SPACES = 2, 3, 4, 5
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
BPE = 2


def fields(message: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of the fields of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = message[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(message):
        key = varint()
        size = {1: 8, 5: 4}.get(key & 7)
        if key & 7 == 0:
            yield key >> 3, varint()
            continue
        size = varint() if size is None else size
        yield key >> 3, message[at : at + size]
        at += size


class CharMap:
    """The compiled character map: a double-array trie of prefixes, and the texts that replace them."""

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist() if blob else []
        self.texts = blob[4 + size :]

    def longest(self, text: bytes, at: int) -> tuple[bytes, int] | None:
        """What replaces the longest prefix of ``text[at:]`` that has a rule, and the prefix's size."""
        if not self.units:
            return None
        units, found, node = self.units, None, self.step(self.units[0])
        for k in range(at, len(text)):
            node ^= text[k]
            unit = units[node]
            if unit & 0x800000FF != text[k]:
                break
            node ^= self.step(unit)
            if unit >> 8 & 1:
                found = units[node] & 0x7FFFFFFF, k + 1 - at
        if found is None:
            return None
        return self.texts[found[0] : self.texts.index(b"\0", found[0])], found[1]

    @staticmethod
    def step(unit: int) -> int:
        """How far a node's children lie from it."""
        return (unit >> 10) << ((unit & 0x200) >> 6)


@dataclass
class Normalizer:
    charsmap: bytes = b""
    dummy_prefix: bool = True
    remove_spaces: bool = True
    rules: CharMap = field(init=False)

    def __post_init__(self):
        self.rules = CharMap(self.charsmap)

    @staticmethod
    def read(message: bytes) -> Normalizer:
        spec = dict(fields(message))
        if not spec.get(ESCAPE_SPACES, 1):
            raise ValueError("a model that does not write spaces as marks")
        return Normalizer(spec.get(CHARSMAP, b""), bool(spec.get(DUMMY_PREFIX, 1)), bool(spec.get(REMOVE_SPACES, 1)))

    def prefix(self, text: bytes, at: int) -> tuple[bytes, int]:
        """The longest rule's text, or the character that stands there, and the bytes it takes."""
        rule = self.rules.longest(text, at)
        if rule:
            return rule
        lead = text[at]
        size = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
        return text[at : at + size], size

    def __call__(self, text: bytes) -> tuple[bytes, np.ndarray | None]:
        """The normalised text, and for each of its bytes and its end the place in ``text``.

        No record: the text was copied after ``lead`` spaces.
        """
        if not text:
            return b"", None
        if not self.charsmap and not self.remove_spaces and MARK not in text:
            return self.lead + text, None
        out, origin, at, was_space = bytearray(), [], 0, self.remove_spaces
        if self.remove_spaces:
            while at < len(text):
                piece, size = self.prefix(text, at)
                if piece != b" ":
                    break
                at += size
            if at == len(text):
                return b"", np.array([0])
        out += self.lead
        origin += [at] * len(self.lead)
        while at < len(text):
            piece, size = self.prefix(text, at)
            if was_space:
                piece = piece.lstrip(b" ")
            if piece:
                was_space = self.remove_spaces and piece.endswith(b" ")
                piece = piece.replace(MARK, b" ")
                out += piece
                origin += [at] * len(piece)
            at += size
        if self.remove_spaces:
            while out.endswith(b" "):
                at = origin.pop()
                out.pop()
        return bytes(out), np.array([*origin, at])

    @property
    def lead(self) -> bytes:
        return b" " if self.dummy_prefix else b""


class Words(dict):
    """What the words seen lately encode to: (id, bytes it stands for) of each piece, as packed integers."""

    def __init__(self, model: Model):
        self.model = model

    def __missing__(self, word: bytes) -> bytes:
        numbers = self.model.encode_word(word)
        packed = struct.pack(f"<{len(numbers)}I", *numbers)
        if len(word) <= LONGEST_WORD:
            if len(self) >= MOST_WORDS:
                self.clear()
            self[word] = packed
        return packed


class Model:
    def __init__(self, blob: bytes):
        """``blob``: the contents of a model file."""
        self.blob = blob
        pieces, self.normalizer = [], Normalizer()
        byte_fallback, self.unk, self.bos, self.eos = 0, 0, 1, 2
        for number, message in fields(blob):
            if number == PIECES:
                piece = dict(fields(message))
                pieces.append((piece[1], struct.unpack("<f", piece.get(2, bytes(4)))[0], piece.get(3, NORMAL)))
            elif number == TRAINER:
                spec = dict(fields(message))
                if spec.get(MODEL_TYPE, 1) != BPE or spec.get(SUFFIX_SPACES, 0):
                    raise ValueError("only byte-pair models with spaces before words")
                byte_fallback = spec.get(BYTE_FALLBACK, 0)
                self.unk, self.bos, self.eos = spec.get(UNK, 0), spec.get(BOS, 1), spec.get(EOS, 2)
            elif number == NORMALIZER:
                self.normalizer = Normalizer.read(message)
        if any(kind in (USER_DEFINED, UNUSED) for _, _, kind in pieces):
            raise ValueError("a model with user-defined or unused pieces")
        plain = [(i, text.replace(MARK, b" "), score) for i, (text, score, kind) in enumerate(pieces) if kind == NORMAL]
        if any(b" " in text.lstrip(b" ") for _, text, _ in plain):
            raise ValueError("a piece has a space after another character: words cannot be cut apart")
        self.ids = {text.decode(): i for i, text, _ in plain}
        self.scores = {text.decode(): score for _, text, score in plain}
        self.bytes = [0] * 256
        self.byte_of = {}
        for i, (text, _, kind) in enumerate(pieces):
            if kind == BYTE:
                value = int(text[1:-1], 16)
                self.bytes[value], self.byte_of[i] = i, value
        self.fallback = bool(byte_fallback) and len(self.byte_of) == 256
        self.texts = [text.replace(MARK, b" ") if kind == NORMAL else b"" for text, _, kind in pieces]
        self.texts[self.unk] = UNKNOWN_TEXT
        for i, value in self.byte_of.items():
            self.texts[i] = bytes([value])
        self.controls = {i for i, (_, _, kind) in enumerate(pieces) if kind == CONTROL}
        self.lines_apart = not any("\n" in text for text in self.ids)
        self.cut = re.compile(rb" *[^ \n]+| +|\n" if self.lines_apart else rb" *[^ ]+| +")
        self.words = Words(self)

    @staticmethod
    def load(model_file: str) -> Model:
        with open(model_file, "rb") as file:
            return Model(file.read())

    def __reduce__(self):
        return Model, (self.blob,)

    def merged(self, word: str) -> list[str]:
        """The word's pieces: the pair of best score becomes one, the leftmost of equals, until none has a piece."""
        parts, scores = list(word), self.scores
        if len(parts) <= SHORT:
            get = scores.get
            pairs = [get(a + b, NONE) for a, b in zip(parts, parts[1:])]
            while pairs:
                best = max(pairs)
                if best == NONE:
                    break
                i = pairs.index(best)
                parts[i : i + 2] = [parts[i] + parts[i + 1]]
                del pairs[i]
                if i:
                    pairs[i - 1] = get(parts[i - 1] + parts[i], NONE)
                if i < len(pairs):
                    pairs[i] = get(parts[i] + parts[i + 1], NONE)
            return parts
        after = list(range(1, len(parts) + 1))
        before = list(range(-1, len(parts) - 1))
        heap = [(-scores[a + b], i, a + b) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in scores]
        heapq.heapify(heap)
        while heap:
            _, i, joined = heapq.heappop(heap)
            j = after[i]
            if not parts[i] or j >= len(parts) or len(parts[i]) + len(parts[j]) != len(joined) or parts[i] + parts[j] != joined:
                continue  # one of the two was merged meanwhile
            parts[i], parts[j], after[i] = joined, "", after[j]
            if after[j] < len(parts):
                before[after[j]] = i
            for a, b in ((before[i], i), (i, after[i])):
                if a >= 0 and b < len(parts) and parts[a] + parts[b] in scores:
                    heapq.heappush(heap, (-scores[parts[a] + parts[b]], a, parts[a] + parts[b]))
        return [p for p in parts if p]

    def encode_word(self, word: bytes) -> list[int]:
        """Id and bytes of the word it stands for of each piece, in turn."""
        out: list[int] = []
        was_unknown = False
        for part in self.merged(word.decode()):
            known = self.ids.get(part)
            raw = part.encode()
            if known is not None:
                out += (known, len(raw))
            elif self.fallback:
                *others, last = MARK if part == " " else raw
                for byte in others:
                    out += (self.bytes[byte], 0)
                out += (self.bytes[last], len(raw))
            elif was_unknown:  # neighbours without a piece are one unknown
                out[-1] += len(raw)
            else:
                out += (self.unk, len(raw))
            was_unknown = known is None
        return out

    def encode(self, text: bytes, ends: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids, and the places in ``text`` where the bytes of each begin and end.

        With ``ends``, the begin and end ids stand around them, for nothing.
        """
        norm, origin = self.normalizer(text)
        packed = b"".join(map(self.words.__getitem__, self.cut.findall(norm)))
        ids, sizes = np.frombuffer(packed, "<u4").reshape(-1, 2).T
        if not self.fallback and self.unk in ids:
            ids, sizes = joined_unknowns(ids, sizes, self.unk)
        places = np.concatenate([[0], np.cumsum(sizes, dtype=np.int64)])
        places = origin[places] if origin is not None else np.maximum(places - len(self.normalizer.lead), 0)
        if not ends:
            return ids, places[:-1], places[1:]
        ids = np.concatenate([[self.bos], ids, [self.eos]])
        return ids, np.concatenate([[0], places[:-1], [len(text)]]), np.concatenate([[0], places[1:], [len(text)]])

    def decode(self, ids: list[int]) -> str:
        """The text of ids: controls vanish, a space put before goes, bytes that are no character become U+FFFD each."""
        start, stop = 0, len(ids)
        while start < stop and ids[start] in self.controls:
            start += 1
        while stop > start and ids[stop - 1] in self.controls:
            stop -= 1
        runs = [ids[start:stop]] if start < stop else []
        if not self.controls.isdisjoint(ids[start:stop]):  # bytes on either side of a control are not of one character
            runs = [list(run) for control, run in itertools.groupby(ids[start:stop], self.controls.__contains__) if not control]
        texts = [b"".join(map(self.texts.__getitem__, run)) for run in runs]
        if runs and runs[0][0] not in self.byte_of and runs[0][0] != self.unk and texts[0].startswith(b" "):
            if self.normalizer.remove_spaces:
                texts[0] = texts[0].lstrip(b" ")
            elif self.normalizer.dummy_prefix:
                texts[0] = texts[0][1:]
        return "".join(map(self.readable, texts))

    @staticmethod
    def readable(raw: bytes) -> str:
        try:
            return raw.decode()
        except UnicodeDecodeError:
            out, at = [], 0
        # Each byte that starts no character is replaced, one by one.
        while at < len(raw):
            lead = raw[at]
            size = 1 if lead < 0xC0 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
            try:
                out.append(raw[at : at + size].decode())
                at += size
            except UnicodeDecodeError:
                out.append("�")
                at += 1
        return "".join(out)


def joined_unknowns(ids: np.ndarray, sizes: np.ndarray, unk: int) -> tuple[np.ndarray, np.ndarray]:
    """Neighbouring unknowns of two words as one."""
    first = np.ones(len(ids), bool)
    first[1:] = ~((ids[1:] == unk) & (ids[:-1] == unk))
    return ids[first], np.add.reduceat(sizes, np.flatnonzero(first))


ENCODED = "doc_id bigint, n_bytes bigint, ids array<int>, begins array<bigint>, ends array<bigint>"


def encode(docs: DataFrame, model_file: str, ends: bool = True) -> DataFrame:
    """doc_id, n_bytes, ids, begins and ends of every document's text.

    ``begins`` and ``ends`` are places in the UTF-8 bytes of the text. With ``ends`` there is a begin id before and an
    end id behind, which stand for nothing.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Model.load(model_file))  # the size of the vocabulary

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            texts = batch.column(1).to_pylist()
            done = [model.encode(text, ends) for text in texts]
            offsets = pa.array(np.cumsum([0, *(len(d[0]) for d in done)]), pa.int32())
            lists = [
                pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([*(d[k] for d in done), []]).astype(kind)))
                for k, kind in enumerate((np.int32, np.int64, np.int64))
            ]
            sizes = pa.array([len(t) for t in texts], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0), sizes, *lists], ["doc_id", "n_bytes", "ids", "begins", "ends"])

    return in_small_batches(docs).select("doc_id", utf8(F.col("text"))).mapInArrow(of, ENCODED)


def decode(encoded: DataFrame, model_file: str) -> DataFrame:
    """``encoded`` with ``decoded``, the text of its ``ids``."""
    shared = encoded.sparkSession.sparkContext.broadcast(Model.load(model_file))
    columns = encoded.columns

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            lists = batch.column(columns.index("ids"))
            edges, flat = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
            decoded = pa.array([model.decode(flat[a:b].tolist()) for a, b in zip(edges, edges[1:])], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, decoded], [*columns, "decoded"])

    schema = ", ".join(f"`{name}` {kind}" for name, kind in encoded.dtypes)
    return encoded.mapInArrow(of, f"{schema}, decoded string")


DIGESTS = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string, spans_sha256 string"


def judge(docs: DataFrame, model_file: str) -> DataFrame:
    """doc_id, n_tokens and digests of the ids, the decoded text and the spans of every document.

    Encoding, decoding and digests are made in one task, so that ids and spans need not be written out in between.
    """
    shared = docs.sparkSession.sparkContext.broadcast(Model.load(model_file))

    def of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            rows = []
            for text in batch.column(1).to_pylist():
                ids, begins, stops = model.encode(text, ends=True)
                decoded = model.decode(ids.tolist())
                parts = (ids.astype("<u4"), decoded.encode(), np.stack([begins, stops]).astype("<u8"))
                rows.append((len(ids), *(hashlib.sha256(part).hexdigest() for part in parts)))
            columns = [pa.array(list(c), kind) for c, kind in zip(zip(*rows), (pa.int64(), pa.string(), pa.string(), pa.string()))] if rows else []
            if rows:
                yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "spans_sha256"])

    return in_small_batches(docs).select("doc_id", utf8(F.col("text"))).mapInArrow(of, DIGESTS)
