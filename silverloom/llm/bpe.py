"""Byte-level BPE: encoding by a lazily determinised transducer, streaming decoding."""

from __future__ import annotations

import base64
import codecs
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverloom.llm.common import ship_code, table

#: States of a transducer, and matches of the pattern with their ids, that a Python worker keeps.
_STATES = 30_000
_UNITS = 150_000
_LONGEST_UNIT = 64
#: Bytes at the beginning of a match that are read once for all matches that begin with them.
_HEAD = 5
#: Bytes of output gathered into one Arrow batch.
_BATCH = 4 << 20


class _State:
    """All tokens that may be being read: the longest end of the input, ``window``, that begins
    a token stands for the set, its shorter ends that do so for the other members. ``ends`` are
    the tokens that may end here, the longest first: length, id, and of the tokens met before it
    whether it may follow them."""

    __slots__ = ("window", "ends", "next")

    def __init__(self, window: bytes, ends: tuple[tuple[int, int, dict[int, bool]], ...]):
        self.window, self.ends = window, ends
        self.next: dict[int, _State] = {}


class Transducer:
    """Encodes bytes by merge ranks, reading each byte once.

    A sequence of tokens is the encoding of its bytes just if every two neighbours are the
    encoding of theirs, so each prefix of the input has one last token: the one that may follow
    the last token of the prefix before it. The sets of tokens in progress are determinised as
    they are first met. The next token begins within the current window, which is no longer than
    the longest token; what the encodings of all those places share is emitted, which bounds the
    lookahead. States and pairs are dropped together when there are too many.
    """

    _EMIT = 4096  # bytes held before what is settled is emitted

    def __init__(self, ranks: dict[bytes, int], max_states: int = _STATES):
        self.ranks, self.max_states = ranks, max_states
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.begins = {token[:i] for token in ranks for i in range(1, len(token) + 1)}
        self._halves: dict[int, tuple[int, int] | None] = {}
        self._clear()

    def _clear(self) -> None:
        self.start = _State(b"", ())
        self.states = {b"": self.start}
        self.pairs: dict[int, dict[int, bool]] = {}
        self.n_pairs = 0
        self.heads: dict[bytes, tuple[_State, list[int]]] = {}

    def merge(self, data: bytes, whole: bool = True) -> list[int]:
        """The definition: join the neighbours of least rank, leftmost first, until none join.
        Without ``whole`` the join that makes all of ``data`` is left out."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > (1 if whole else 2):
            ranks = [self.ranks.get(a + b, 1 << 60) for a, b in zip(parts, parts[1:])]
            least = min(ranks)
            if least == 1 << 60:
                break
            i = ranks.index(least)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
        return [self.ranks[p] for p in parts]

    def _split(self, token: int) -> tuple[int, int] | None:
        """The two tokens whose join makes this one; None for a single byte."""
        if token not in self._halves:
            data = self.bytes_of[token]
            self._halves[token] = tuple(self.merge(data, whole=False)) if len(data) > 1 else None
        return self._halves[token]

    def may_follow(self, a: int, b: int) -> bool:
        """Whether the tokens' bytes, put together, are encoded as just these two.

        Joins happen in order of rank. Taking the two tokens apart, the later join first, shows
        the pairs that met at the border; one that joins before either side grew forbids it.
        """
        ranks, bytes_of = self.ranks, self.bytes_of
        grown_a = grown_b = 1 << 60  # rank of the join that ended the left and right piece
        while True:
            joined = ranks.get(bytes_of[a] + bytes_of[b], 1 << 60)
            # Of two joins of one rank the left one comes first.
            if joined < grown_a and joined <= grown_b:
                return False
            left, right = self._split(a), self._split(b)
            if left is None and right is None:
                return True
            if right is None or (left is not None and a > b):
                grown_a, a = a, left[1]
            else:
                grown_b, b = b, right[0]

    def _learn(self, follows: dict[int, bool], left: int, token: int) -> bool:
        self.n_pairs += 1
        follows[left] = self.may_follow(left, token)
        return follows[left]

    def _next(self, state: _State, byte: int) -> _State:
        window = state.window + bytes((byte,))
        while window not in self.begins:
            window = window[1:]
            if not window:
                raise ValueError("the ranks lack a byte")
        found = self.states.get(window)
        if found is None:
            ends = []
            for i in range(len(window)):
                token = self.ranks.get(window[i:])
                if token is not None:  # at the beginning (-1) every token may stand
                    ends.append((len(window) - i, token, self.pairs.setdefault(token, {-1: True})))
            found = self.states[window] = _State(window, tuple(ends))
        state.next[byte] = found
        return found

    def encode(self, data: bytes) -> list[int]:
        most = self.max_states
        if max(len(self.states), len(self.heads)) > most or self.n_pairs > 10 * most:
            self._clear()
        if len(data) <= self._EMIT:
            return self._encode_short(data)
        state, out = self.start, []
        last, size_of = [-1], [0]  # last token, and its length, of each prefix; then of what is held
        for byte in data:
            state = state.next.get(byte) or self._next(state, byte)
            for size, token, follows in state.ends:
                left = last[-size] if size <= len(last) else None
                if left is None:
                    continue
                may = follows.get(left)
                if may is None:
                    may = self._learn(follows, left, token)
                if may:
                    break
            else:
                raise ValueError("the ranks are no order of merges")
            last.append(token)
            size_of.append(size)
            if len(last) > self._EMIT + len(state.window):
                shared = self._shared(size_of, len(state.window))
                out += self._path(last, size_of, shared)
                last, size_of = last[shared:], size_of[shared:]
        return out + self._path(last, size_of, len(last) - 1)

    def _read(self, state: _State, last: list[int], data: bytes) -> _State:
        """Add the last token of each further prefix to ``last``."""
        for byte in data:
            try:
                state = state.next[byte]
            except KeyError:
                state = self._next(state, byte)
            for size, token, follows in state.ends:
                left = last[-size]
                may = follows.get(left)
                if may is None:
                    may = self._learn(follows, left, token)
                if may:
                    break
            else:
                raise ValueError("the ranks are no order of merges")
            last.append(token)
        return state

    def _encode_short(self, data: bytes) -> list[int]:
        """The same where nothing has to be emitted before the end."""
        head = self.heads.get(data[:_HEAD])
        if head is None:
            last = [-1]
            state = self._read(self.start, last, data[:_HEAD])
            self.heads[data[:_HEAD]] = head = state, last
        state, last = head
        last = last[:]
        self._read(state, last, data[_HEAD:])
        tokens, end, bytes_of = [], len(data), self.bytes_of
        while end > 0:
            token = last[end]
            tokens.append(token)
            end -= len(bytes_of[token])
        return tokens[::-1]

    @staticmethod
    def _shared(size_of: list[int], window: int) -> int:
        """The last place through which the encodings of all places in the window go."""
        places = set(range(len(size_of) - 1 - window, len(size_of)))
        while len(places) > 1:
            place = max(places)
            places.remove(place)
            places.add(place - size_of[place])
        return places.pop()

    @staticmethod
    def _path(last: list[int], size_of: list[int], end: int) -> list[int]:
        tokens = []
        while end > 0:
            tokens.append(last[end])
            end -= size_of[end]
        return tokens[::-1]


class Decoder:
    """Ids in, text out, piece by piece: a character split over tokens waits for its rest.

    Bytes that are no UTF-8 become U+FFFD, an unknown id raises KeyError.
    """

    def __init__(self, bytes_of: dict[int, bytes]):
        self._bytes = bytes_of.__getitem__
        self._machine = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: Iterable[int]) -> str:
        return self._machine.decode(b"".join(map(self._bytes, ids)))

    def finish(self) -> str:
        return self._machine.decode(b"", True)


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class Encoder:
    """Whole texts to ids: each match of the pattern apart, a token of its own if it is one.

    The ids of the matches met last are ``known``; when these are half of ``_UNITS`` they become
    ``pieces``, the ones met before, which are known again when they are met again.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.machine = Transducer(ranks)
        self.find = regex.compile(pattern).findall
        self.known: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def _ids(self, piece: str) -> bytes:
        data = piece.encode()
        whole = self.machine.ranks.get(data)
        ids = self.machine.encode(data) if whole is None else (whole,)
        return array("I", ids).tobytes()

    def _piece(self, piece: str) -> bytes:
        found = self.pieces.get(piece) or self._ids(piece)
        if len(piece) <= _LONGEST_UNIT:
            if len(self.known) >= max(_UNITS // 2, 1):
                self.pieces, self.known = self.known, {}
            self.known[piece] = found
        return found

    def encode(self, text: str) -> bytes:
        pieces = self.find(text)
        out = list(map(self.known.get, pieces))
        for i in [i for i, found in enumerate(out) if found is None]:
            out[i] = self.known.get(pieces[i]) or self._piece(pieces[i])
        return b"".join(out)


@lru_cache(maxsize=2)
def _encoder(ranks: str, pattern: str) -> Encoder:
    return Encoder(read_ranks(ranks), pattern)


@lru_cache(maxsize=2)
def _token_bytes(ranks: str) -> dict[int, bytes]:
    return {rank: token for token, rank in read_ranks(ranks).items()}


def _decode(value: bytes, bytes_of: dict[int, bytes], step: int) -> str:
    numbers, stream = np.frombuffer(value, "<u4"), Decoder(bytes_of)
    pieces = [stream.feed(numbers[i : i + step].tolist()) for i in range(0, len(numbers), step)]
    return "".join([*pieces, stream.finish()])


def _appended(df: DataFrame, source: str, new: dict[str, str], make) -> DataFrame:
    """``df`` with columns made from ``source`` batch by batch; ``make()`` gives the function,
    which returns a value for each new column."""
    if source in new:
        raise ValueError("the new column needs a name of its own")
    ship_code(df.sparkSession)
    arrow = {"binary": pa.binary(), "string": pa.string()}
    types = [arrow[kind] for kind in new.values()]
    kept = df.drop(*new)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            values, first, held = [], 0, 0
            for i, value in enumerate(batch.column(source)):
                values.append(work(value.as_py()))
                held += sum(len(v or b"") for v in values[-1])
                if held > _BATCH or i + 1 == batch.num_rows:
                    part = batch.slice(first, len(values))
                    made = [pa.array(v, t) for v, t in zip(zip(*values), types)]
                    names = [*part.schema.names, *new]
                    yield pa.RecordBatch.from_arrays([*part.columns, *made], names)
                    values, first, held = [], i + 1, 0

    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema]
    return kept.mapInArrow(run, ", ".join([*fields, *(f"`{n}` {kind}" for n, kind in new.items())]))


def encode_documents(
    df: DataFrame, ranks: str, pattern: str, text: str = "text", ids: str = "ids"
) -> DataFrame:
    """Add the ids of every whole text, as little-endian unsigned 32-bit integers in a binary.

    Null and empty texts have no ids (an empty binary). Special tokens are ordinary text. A
    column named like the new one is replaced. A worker's memory: one batch, the bounded states
    and units, and the longest text; rows are worked on where they are read, without a shuffle.
    """


    def make():
        encoder = _encoder(ranks, pattern)
        return lambda value: (encoder.encode(value or ""),)

    return _appended(df, text, {ids: "binary"}, make)


def decode_documents(
    df: DataFrame, ranks: str, ids: str = "ids", text: str = "decoded", step: int = 4096
) -> DataFrame:
    """Add the text of ids made by :func:`encode_documents`; null for null."""

    def make():
        bytes_of = _token_bytes(ranks)
        return lambda value: (None if value is None else _decode(value, bytes_of, step),)

    return _appended(df, ids, {text: "string"}, make)


def code_documents(
    df: DataFrame,
    ranks: str,
    pattern: str,
    text: str = "text",
    ids: str = "ids",
    decoded: str = "decoded",
    step: int = 4096,
) -> DataFrame:
    """Add the ids of every whole text, as :func:`encode_documents` does, and the text that they
    decode to (empty for null), in one pass and one Python worker per task."""
    if ids == decoded:
        raise ValueError("the new columns need names of their own")

    def make():
        encoder = _encoder(ranks, pattern)
        bytes_of = encoder.machine.bytes_of

        def work(value: str | None) -> tuple[bytes, str]:
            found = encoder.encode(value or "")
            return found, _decode(found, bytes_of, step)

        return work

    return _appended(df, text, {ids: "binary", decoded: "string"}, make)


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return code_documents(docs, ranks, public_tokenizers.PATTERN).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
