"""Token counts by a compiled tokenizer: a deterministic transducer whose transitions carry emitted-token counts.

A byte-pair tokenizer's answer for a growing text is fixed by its last token at each recent position: the token that
ends at a position is the one whose own encoding is itself and that stands beside the token before it when both are
encoded together. So a state holds the longest suffix that could still grow into a piece, with the last token and the
relative count at each of its positions; reading a character gives the next state and the change in the number of
tokens. States are finite, and are compiled when they are first reached.

No piece holds a space mark after another character, and line feeds are in no piece, so the transducer is in a known
state there: what stands behind is a count and a state, whatever came before. What stands before the first such place
of a chunk depends on the state that comes in. If it is long, its map is a table: walks that start at different
characters come together soon, so a few states stand for all, and each has the count and the state at the end. Maps
compose associatively, by pairs, as in a parallel prefix scan: the state that arrives is walked along the first
characters only and then found in the table. One that is not there walks along the bytes, which the map carries for
that case; texts whose walks do not come together have no table either. Texts are cut into chunks of ``CHUNK`` bytes; a
very long text is many chunks, mapped without regard to each other.

Defined cases: a null or empty text has no bytes and no tokens; a text of one character, of spaces only or without any
space is a head or tail like any other; special strings are ordinary text; repeated rows and null ids are counted row
by row; an empty table gives no rows.
"""

from __future__ import annotations

import pickle
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from farebox.llm.common import in_small_batches

CHUNK = 1 << 20
LIMIT = 4096
MOST_STATES = 200_000
MOST_WORDS = 600_000
LONGEST_WORD = 64
SHORT = 1 << 13  # bytes up to which a part of a text is its own map

MARK = "\u2581"
START, OTHER = "", "\n"  # names of the last token before the text, and after a character that is in no piece
FIRST = ("", ((START, 0),))  # the state before a text
MOST_COLUMNS = 16


class Words(dict):
    """Counts of the words seen lately, made when they are first asked for."""

    def __init__(self, transducer: Transducer):
        self.transducer = transducer

    def __missing__(self, word: bytes) -> int:
        count = self.transducer.run(word.decode().replace(" ", MARK))
        if len(word) <= LONGEST_WORD:
            if len(self) >= MOST_WORDS:
                self.clear()
            self[word] = count
        return count


class Transducer:
    """Counts tokens as a sentencepiece BPE model does, without its library. ``scores``: piece to score."""

    def __init__(self, scores: dict[str, float]):
        self.scores = scores
        if any(MARK in p.lstrip(MARK) for p in scores):
            raise ValueError("a piece has a space mark after another character: words cannot be cut apart")
        self.breaks = not any("\n" in p for p in scores)
        self.chars = {c for p in scores for c in p}
        self.prefixes = {p[:k] for p in scores for k in range(1, len(p))}
        self.word = re.compile(rb" *[^ \n]+| +" if self.breaks else rb" +[^ ]*|[^ ]+")
        self.reset = re.compile(rb"(?<=[^ ]) |\n" if self.breaks else rb"(?<=[^ ]) ")
        self.lone: dict[str, bool] = {}
        self.beside: dict[tuple[str, str], bool] = {}
        self.longest = max(map(len, scores), default=1)
        self.short = SHORT
        self.clear_states()
        self.counts = Words(self)

    @staticmethod
    def load(model_file: str) -> Transducer:
        """Pieces and scores of a model file. Control, unknown and byte pieces take no part in merges."""
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=model_file)
        plain = (i for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i)))
        return Transducer({sp.id_to_piece(i): sp.get_score(i) for i in plain})

    def __reduce__(self):
        return Transducer, (self.scores,)

    def clear_states(self) -> None:
        self.states: dict[tuple, int] = {}
        self.moves: list[dict[str, tuple[int, int]]] = []
        self.names: list[tuple] = []
        self.state_of(FIRST)

    def state_of(self, name: tuple) -> int:
        """``name``: the suffix that may grow, and (last token, count less than now) at each of its positions."""
        at = self.states.get(name)
        if at is None:
            at = self.states[name] = len(self.names)
            self.names.append(name)
            self.moves.append({})
        return at

    def encode(self, text: str) -> list[str]:
        """Pieces of a short text, by merging the best pair again and again."""
        parts = list(text)
        while True:
            best = max(
                ((self.scores[a + b], -i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in self.scores),
                default=None,
            )
            if best is None:
                return parts
            i = -best[1]
            parts[i : i + 2] = [parts[i] + parts[i + 1]]

    def stands(self, token: str) -> bool:
        if token not in self.lone:
            self.lone[token] = self.encode(token) == [token]
        return self.lone[token]

    def may_follow(self, a: str, b: str) -> bool:
        if a in (START, OTHER):
            return True
        if (a, b) not in self.beside:
            if len(self.beside) >= MOST_STATES:
                self.beside.clear()
            self.beside[a, b] = self.encode(a + b) == [a, b]
        return self.beside[a, b]

    def cost(self, token: str) -> int:
        return 1 if token in self.scores else len(token.encode())

    def compile(self, state: int, char: str) -> tuple[int, int]:
        """The transition of a state by a character: next state, and the change in the number of tokens."""
        suffix, past = self.names[state]
        if char not in self.chars:
            return self.state_of(("", ((OTHER, 0),))), len(char.encode())
        grown = suffix + char
        for size in range(len(grown), 0, -1):
            token = grown[-size:]
            before, less = past[len(past) - size]
            if (size == 1 or token in self.scores) and self.stands(token) and self.may_follow(before, token):
                change = less + self.cost(token)
                break
        history = [(t, k - change) for t, k in past] + [(token, 0)]
        keep = next((k for k in range(min(len(grown), len(history) - 1), 0, -1) if grown[-k:] in self.prefixes), 0)
        return self.state_of((grown[-keep:] if keep else "", tuple(history[len(history) - keep - 1 :]))), change

    def walk(self, name: tuple, text: str) -> tuple[int, tuple]:
        """From the state of a name along a normalised text: the change in the number of tokens, and the state's name."""
        if len(self.names) > MOST_STATES:
            self.clear_states()
        state, total, moves = self.state_of(name), 0, self.moves
        for char in text:
            try:
                state, change = moves[state][char]
            except KeyError:
                if len(self.names) > 2 * MOST_STATES:  # in a long text without a space
                    name = self.names[state]
                    self.clear_states()
                    state, moves = self.state_of(name), self.moves
                move = moves[state][char] = self.compile(state, char)
                state, change = move
            total += change
        return total, self.names[state]

    def run(self, text: str) -> int:
        """Tokens of a normalised piece of text, from the start state."""
        return self.walk(FIRST, text)[0]

    def count(self, text: bytes) -> int:
        """Tokens of a text that starts and ends where the state is known."""
        total = text.count(b"\n") if self.breaks else 0
        return total + sum(map(self.counts.__getitem__, self.word.findall(text)))

    # State maps: (parts, rest). The parts are what comes before the first known state; what they count depends on the
    # state that comes in. The rest, if there is a known state, is (count, state, bytes of a character cut in two).

    def chunk_map(self, chunk: bytes) -> tuple:
        found = self.reset.search(chunk)
        if not found:
            return ([self.part(chunk)] if chunk else []), None
        head = chunk[: found.start()]
        return ([self.part(head)] if head else []), self.closed(chunk[found.start() :])

    def closed(self, text: bytes) -> tuple[int, tuple, bytes]:
        """Count and state at the end of a text that starts where the state is known."""
        if self.breaks and text.endswith(b"\n"):
            return self.count(text), FIRST, b""
        words = self.word.findall(text)
        last = words[-1] if words else b""
        return self.onward((self.count(text[: len(text) - len(last)]), FIRST, b""), (last, None, b""))

    def part(self, raw: bytes) -> tuple[bytes, dict | None, bytes]:
        """(bytes to walk, table, bytes behind the table): the state map of text without a known state inside.

        Walks from every place of the first ``self.longest`` characters come together soon. The states they reach after
        some more are the table's, with what the rest of the text makes of each: (change, state, cut character).
        """
        start = next((k for k in range(min(4, len(raw))) if raw[k] & 0xC0 != 0x80), 0)
        if len(raw) <= self.short:
            return raw, None, b""
        text, cut = whole(raw[start:])
        lead = text[: 4 * self.longest]
        at = start + len(lead.encode())
        states = {self.walk(FIRST, lead[j:].replace(" ", MARK))[1] for j in range(self.longest)}
        if len(states) > MOST_COLUMNS:
            return raw, None, b""
        rest = text[len(lead) :].replace(" ", MARK)
        return raw[:at], {name: (*self.walk(name, rest), cut) for name in states}, raw[at:]

    def onward(self, now: tuple[int, tuple, bytes], part: tuple[bytes, dict | None, bytes]) -> tuple[int, tuple, bytes]:
        """Count and state after a part. A state that its table does not have walks along its bytes."""
        (count, name, cut), (lead, table, behind) = now, part
        text, cut = whole(cut + lead)
        change, name = self.walk(name, text.replace(" ", MARK))
        if table is None:
            return count + change, name, cut
        if name in table and not cut:
            more, name, cut = table[name]
            return count + change + more, name, cut
        return self.onward((count + change, name, cut), (behind, None, b""))

    def compose(self, a: tuple, b: tuple) -> tuple:
        """The map of ``a`` followed by ``b``."""
        (a_parts, a_rest), (b_parts, b_rest) = a, b
        if a_rest is None:
            return a_parts + b_parts, b_rest
        for part in b_parts:
            a_rest = self.onward(a_rest, part)
        return a_parts, a_rest if b_rest is None else (a_rest[0] + b_rest[0], *b_rest[1:])

    def scan(self, maps: list[tuple]) -> int:
        """Tokens of a whole text from the maps of its chunks, composed in pairs, level by level."""
        while len(maps) > 1:
            pairs = [self.compose(a, b) for a, b in zip(maps[::2], maps[1::2])]
            maps = pairs + maps[len(maps) & ~1 :]
        return self.compose(([], (0, FIRST, b"")), maps[0])[1][0]


def whole(raw: bytes) -> tuple[str, bytes]:
    """The characters of ``raw``, and the bytes of one that is cut off at its end."""
    for k in range(1, min(4, len(raw)) + 1):
        lead = raw[-k]
        if lead & 0xC0 != 0x80:
            if k < (1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4):
                return raw[:-k].decode(), raw[-k:]
            break
    return raw.decode(), b""


def chunks_of(text: Column) -> Column:
    """Slices of a text's bytes, with the mark that the model puts before every text that is not empty."""
    body = F.concat(F.lit(" "), F.replace(text, F.lit(MARK), F.lit(" "))).cast("binary")
    last = F.floor((F.octet_length(body) - 1) / CHUNK).cast("int")
    slices = F.transform(F.sequence(F.lit(0), last), lambda k: F.substring(body, k * CHUNK + 1, F.lit(CHUNK)))
    return F.when(F.octet_length(text) > 0, slices).otherwise(F.array(F.lit(b"").cast("binary")))


def count_tokens(docs: DataFrame, model_file: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of every document."""
    shared = in_small_batches(docs).sparkSession.sparkContext.broadcast(Transducer.load(model_file))  # the size of the vocabulary

    @F.pandas_udf("binary")
    def mapped(chunks: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in chunks:
            yield pd.Series([pickle.dumps(shared.value.chunk_map(c)) for c in part], dtype=object)

    @F.pandas_udf("long")
    def scanned(lists: pd.Series) -> pd.Series:
        return pd.Series([shared.value.scan([pickle.loads(m["m"]) for m in maps]) for maps in lists], dtype=int)

    text = F.coalesce("text", F.lit(""))
    # Numbered below the explode: in one projection with it, every chunk would get a number of its own.
    numbered = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", text.alias("text"))
    size = F.octet_length("text").cast("long").alias("n_bytes")
    rows = numbered.select("row", "doc_id", size, F.posexplode(chunks_of(F.col("text"))).alias("k", "chunk"))
    maps = rows.select("row", "doc_id", "n_bytes", "k", mapped("chunk").alias("m"))
    whole = maps.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"),
        F.first("n_bytes").alias("n_bytes"),
        F.array_sort(F.collect_list(F.struct("k", "m"))).alias("maps"),
    )
    counted = whole.select("doc_id", "n_bytes", scanned("maps").alias("n_tokens"))
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
