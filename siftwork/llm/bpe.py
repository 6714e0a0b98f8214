"""Byte-level BPE as a streaming transducer with bounded lookahead, and its decoder.

The merge list itself says how far the bytes behind a position can influence the tokens before
it: ``sufficient_lookahead`` follows, in order of rank, which tokens a merge can take from a
token's right side, and what that in turn depends on. Within one piece of text, tokens that end
at least this far before the end of what has been read can't change any more, so they are
emitted and forgotten. Pieces come from a pattern that needs a few characters of lookahead. The
encoder holds the text not yet decided, never a whole document.

Decoding turns ids into bytes and feeds them to an incremental UTF-8 state machine; ill-formed
bytes become U+FFFD. Null and empty texts have no tokens. Lone surrogates can't occur in Spark
strings. A special token's string in the text becomes that special token.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import json
import re
import sys
import unicodedata
from collections.abc import Iterable, Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from siftwork.llm.common import batches_of, give_back, id_and_text, read

#: Characters handed to the encoder at a time.
CHUNK = 1 << 16
#: A piece longer than this is encoded while it is still growing.
OPEN_PIECE = 4096
#: Pieces remembered with their tokens, in each of two generations.
REMEMBERED = 400_000


#: Rank of a pair that never merges.
NEVER = (1 << 60, -1)


# --- merges -----------------------------------------------------------------------------


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in vocabulary files, to the byte.

    Printable characters of Latin-1 stand for themselves, the other bytes for the characters
    from U+0100 on, in order.
    """
    printable = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    others = [b for b in range(256) if b not in set(printable)]
    letters = {chr(b): b for b in printable}
    return letters | {chr(256 + i): b for i, b in enumerate(others)}


class Merges:
    """Vocabulary and ranked merges of a tokenizer file, in bytes."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        letters = byte_letters()
        special = {t["content"]: t["id"] for t in model.get("added_tokens", [])}
        self.special = special
        self.bytes_of: dict[int, bytes] = {}
        ids: dict[str, int] = model["model"]["vocab"]
        for token, number in ids.items():
            if token not in special:
                self.bytes_of[number] = bytes(letters[c] for c in token)
        self.bytes_of |= {number: token.encode() for token, number in special.items()}
        self.first = [0] * 256
        for token, number in ids.items():
            if len(token) == 1:
                self.first[letters[token]] = number
        #: (left id, right id) to (rank, merged id)
        self.ranks: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["model"]["merges"]):
            left, right = pair if isinstance(pair, list) else pair.split(" ")
            self.ranks[ids[left], ids[right]] = rank, ids[left + right]
        self.longest = max(map(len, self.bytes_of.values()))
        self.lookahead = sufficient_lookahead(self)

    def encode(self, piece: bytes) -> list[int]:
        """All merges of a short piece, lowest rank first and then from the left."""
        tokens = [self.first[b] for b in piece]
        if len(tokens) > 24:
            return self._encode_by_heap(tokens)
        get = self.ranks.get
        found = [get(pair, NEVER) for pair in zip(tokens, tokens[1:])]
        while found:
            best = min(found)
            if best is NEVER:
                break
            i = found.index(best)
            tokens[i : i + 2] = [best[1]]
            del found[i]
            if i:
                found[i - 1] = get((tokens[i - 1], tokens[i]), NEVER)
            if i < len(found):
                found[i] = get((tokens[i], tokens[i + 1]), NEVER)
        return tokens

    def _encode_by_heap(self, tokens: list[int]) -> list[int]:
        n = len(tokens)
        left, right, ranks = list(range(-1, n - 1)), list(range(1, n + 1)), self.ranks
        heap = []
        for i in range(n - 1):
            if found := ranks.get((tokens[i], tokens[i + 1])):
                heap.append((found[0], i, tokens[i], tokens[i + 1], found[1]))
        heapq.heapify(heap)
        while heap:
            _, i, a, b, merged = heapq.heappop(heap)
            j = right[i]
            if tokens[i] != a or j >= n or tokens[j] != b:
                continue
            tokens[i], tokens[j] = merged, -1
            right[i] = right[j]
            if right[j] < n:
                left[right[j]] = i
            for x, y in ((left[i], i), (i, right[i])):
                if x >= 0 and y < n and (found := ranks.get((tokens[x], tokens[y]))):
                    heapq.heappush(heap, (found[0], x, tokens[x], tokens[y], found[1]))
        return [t for t in tokens if t >= 0]


def sufficient_lookahead(merges: Merges) -> int:
    """Bytes behind a token's end that can decide whether the token is there.

    Let reach(t, r) be that number for token t once the merges of a rank below r are done. A
    merge (t, w) of rank q < r takes t away if w is there, which depends on the len(w) bytes of w
    and on reach(w, q). A merge (x, t) takes it away if x is there: reach(x, q) - len(t) bytes. And
    t itself comes from a merge (u, v) of rank q: reach(v, q) and reach(u, q) - len(v). So one
    walk through the merges by rank gives the largest reach of each token.
    """
    length = {t: len(b) for t, b in merges.bytes_of.items()}
    reach: dict[int, int] = {}
    for (u, v), (_, merged) in sorted(merges.ranks.items(), key=lambda item: item[1][0]):
        of_u, of_v = reach.get(u, 0), reach.get(v, 0)
        made = max(of_v, of_u - length[v], 0)
        reach[merged] = max(reach.get(merged, 0), made)
        reach[u] = max(of_u, length[v] + of_v)
        reach[v] = max(reach.get(v, 0), of_u - length[v])
    return max(reach.values(), default=0)


# --- pieces -----------------------------------------------------------------------------


def _class(wanted: str, below: int = sys.maxunicode + 1) -> str:
    """The characters of general categories that start with ``wanted``, for a regex class."""
    out, start = [], None
    for code in range(below + 1):
        inside = code < below and unicodedata.category(chr(code))[0] == wanted
        if inside and start is None:
            start = code
        elif not inside and start is not None:
            out.append(f"\\U{start:08x}-\\U{code - 1:08x}")
            start = None
    return "".join(out)


#: The property White_Space of Unicode, as fixed values.
WHITE = (
    r"\x09-\x0D\x20\x85\xA0  -     　"
)


#: Below this code point there are few classes of characters, and a small pattern does.
LOW = 0x250


class Pieces:
    """The pattern that cuts text before merging: contractions, words, numbers, rest, spaces."""

    def __init__(self):
        self.high = re.compile(f"[^\\x00-\\u{LOW - 1:04x}]")
        self.low_pattern = self._pattern(_class("L", LOW), _class("N", LOW))
        letters, numbers = _class("L"), _class("N")
        self.full_pattern = self._pattern(letters, numbers)
        rest = f"[^{WHITE}{letters}{numbers}]"
        self.runs = [re.compile(f"{c}+") for c in (f"[{letters}]", f"[{numbers}]", rest)]
        self.space = re.compile(f"[{WHITE}]+")
        self.space_end = re.compile(f"[{WHITE}]+$(?!\n)")

    @staticmethod
    def _pattern(letters: str, numbers: str) -> re.Pattern:
        return re.compile(
            f"'(?:s|t|re|ve|m|ll|d)| ?[{letters}]+| ?[{numbers}]+| ?[^{WHITE}{letters}{numbers}]+"
            f"|[{WHITE}]+(?![^{WHITE}])|[{WHITE}]+"
        )

    def of(self, text: str) -> re.Pattern:
        return self.full_pattern if self.high.search(text) else self.low_pattern

    def run_of(self, piece: str) -> re.Pattern:
        """The pattern of the characters that make this piece longer."""
        last = piece[-1]
        return next((run for run in self.runs if run.match(last)), self.space)


class _Remembered(dict):
    """Tokens of the pieces met lately: two generations of at most ``REMEMBERED`` each."""

    def __init__(self, merges: Merges):
        super().__init__()
        self.merges = merges
        self.older: dict[str, tuple[int, ...]] = {}

    def forget(self) -> None:
        self.clear()
        self.older.clear()

    def __missing__(self, piece: str) -> tuple[int, ...]:
        tokens = self.older.get(piece)
        if tokens is None:
            data = piece.encode("utf-8")
            if len(data) > 256:
                window = _Window(self.merges)
                return tuple(window.feed(data)) + tuple(window.finish())
            tokens = tuple(self.merges.encode(data))
        if len(self) >= REMEMBERED:
            self.older = dict(self)
            self.clear()
        self[piece] = tokens
        return tokens


class _Window:
    """Tokens of one piece, emitted as soon as no later byte can change them."""

    def __init__(self, merges: Merges):
        self.merges = merges
        self.held = b""
        self.size = 4 * (merges.lookahead + merges.longest) + 256

    def feed(self, data: bytes) -> Iterator[int]:
        self.held += data
        while len(self.held) > self.size:
            yield from self._stable()

    def _stable(self) -> Iterator[int]:
        window, at = self.held[: self.size], 0
        for token in self.merges.encode(window):
            end = at + len(self.merges.bytes_of[token])
            if end + self.merges.lookahead > len(window):
                break
            yield token
            at = end
        # What follows a token's end is encoded as if the text began there.
        self.held = self.held[at:]

    def finish(self) -> Iterator[int]:
        yield from self.merges.encode(self.held)
        self.held = b""


# --- transducers ------------------------------------------------------------------------


class Tokenizer:
    """Merges, pieces and remembered pieces of one vocabulary file."""

    def __init__(self, path: str):
        self.merges = Merges(path)
        self.pieces = Pieces()
        self.remembered = _Remembered(self.merges)
        self.decimal = {i: str(i) for i in self.merges.bytes_of}
        strings = sorted(map(re.escape, self.merges.special), key=len, reverse=True)
        self.special = re.compile("|".join(strings)) if strings else None

    def encoder(self) -> Encoder:
        return Encoder(self)

    def encode(self, text: str) -> list[int]:
        encoder, out = self.encoder(), []
        for at in range(0, len(text), CHUNK):
            out += encoder.feed(text[at : at + CHUNK])
        return out + encoder.finish()

    def decoder(self) -> Decoder:
        return Decoder(self.merges.bytes_of)

    def decode(self, ids: Iterable[int]) -> str:
        decoder = self.decoder()
        return decoder.feed(ids) + decoder.finish()


class Encoder:
    """Text in, ids out. Holds the last undecided characters, or an open piece's last bytes."""

    def __init__(self, tokenizer: Tokenizer):
        self.tokenizer = tokenizer
        self.held = ""
        self.window: _Window | None = None
        self.run: re.Pattern | None = None

    def feed(self, chunk: str) -> list[int]:
        text = self.held + chunk
        special = self.tokenizer.special
        out: list[int] = []
        if special is not None:
            at = 0
            for match in special.finditer(text):
                out += self._plain(text[at : match.start()], last=True)
                out.append(self.tokenizer.merges.special[match.group()])
                at = match.end()
            text = text[at:]
        return out + self._plain(text, last=False)

    def finish(self) -> list[int]:
        return self._plain(self.held, last=True)

    def _undecided(self, text: str) -> int:
        """Where the longest end of the text starts that may begin a special token."""
        longest = max(map(len, self.tokenizer.merges.special), default=1) - 1
        for at in range(max(0, len(text) - longest), len(text)):
            end = text[at:]
            if any(token.startswith(end) for token in self.tokenizer.merges.special):
                return at
        return len(text)

    def _plain(self, text: str, last: bool) -> list[int]:
        self.held = ""
        out: list[int] = []
        if self.run is not None:
            text = self._continue(text, last, out)
        if self.run is not None or not text:
            return out
        remembered = self.tokenizer.remembered
        if last:
            pieces = self.tokenizer.pieces.of(text).findall(text)
            out.extend(chain.from_iterable(map(remembered.__getitem__, pieces)))
            return out
        # A contraction has up to three characters; a piece that ends before is decided once
        # another piece follows it.
        limit, undecided = len(text) - 3, self._undecided(text)
        if undecided < len(text):
            # White space before a special token is one piece, before a word it is not.
            limit = min(limit, len(self.tokenizer.pieces.space_end.sub("", text[:undecided])))
        pieces = self.tokenizer.pieces.of(text).findall(text)
        end = len(text)
        while pieces and (end > limit or end == len(text)):
            end -= len(pieces.pop())
        out.extend(chain.from_iterable(map(remembered.__getitem__, pieces)))
        self.held = text[end:]
        if len(self.held) > OPEN_PIECE:
            self._open(out)
        return out

    def _open(self, out: list[int]) -> None:
        """Start to encode a long piece of which more is to come."""
        first = self.tokenizer.pieces.of(self.held).match(self.held)
        cut = min(first.end(), self._undecided(self.held)) - 1
        if cut < OPEN_PIECE // 2:
            return
        self.run = self.tokenizer.pieces.run_of(self.held[:cut])
        self.window = _Window(self.tokenizer.merges)
        out.extend(self.window.feed(self.held[:cut].encode("utf-8")))
        self.held = self.held[cut:]

    def _continue(self, text: str, last: bool, out: list[int]) -> str:
        """Feed the open piece; returns the text behind it."""
        match = self.run.match(text)
        end = match.end() if match else 0
        if end < len(text) and (last or self._undecided(text) > end):
            # Of white space before a word, the last character belongs to what follows.
            cut = end - 1 if self.run is self.tokenizer.pieces.space else end
        elif last:
            cut = end
        else:
            cut = max(0, min(end, self._undecided(text)) - 1)
            out.extend(self.window.feed(text[:cut].encode("utf-8")))
            self.held = text[cut:]
            return ""
        out.extend(self.window.feed(text[: max(0, cut)].encode("utf-8")))
        out.extend(self.window.finish())
        self.run = self.window = None
        return text[max(0, cut) :]


class Decoder:
    """Ids in, text out. Holds the bytes of an unfinished character."""

    def __init__(self, bytes_of: dict[int, bytes]):
        self.bytes_of = bytes_of
        self.machine = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: Iterable[int]) -> str:
        return self.machine.decode(b"".join(map(self.bytes_of.__getitem__, ids)))

    def finish(self) -> str:
        return self.machine.decode(b"", final=True)


# --- Spark ------------------------------------------------------------------------------

_tokenizers: dict[str, Tokenizer] = {}


def tokenizer_of(path: str) -> Tokenizer:
    """One tokenizer for each worker and file."""
    if path not in _tokenizers:
        _tokenizers[path] = Tokenizer(path)
    return _tokenizers[path]


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _with_tokenizer(path: str, rows, schema: pa.Schema, size: int = 1024):
    """A task that runs ``rows(tokenizer, batches)``; the pieces it remembered go at its end.

    Workers wait for further tasks, of any stage, and the pieces of two tasks take some 140 MB in each.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = tokenizer_of(path)
        try:
            yield from batches_of(rows(tokenizer, batches), schema, size)
        finally:
            tokenizer.remembered.forget()
            give_back()

    return run


def _texts(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, str]]:
    for batch in batches:
        texts = batch.column(1)
        for i, doc_id in enumerate(batch.column(0).to_pylist()):
            yield doc_id, texts[i].as_py()


def encode_column(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id and the array of token ids of each document."""
    schema = pa.schema([("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])

    def encode(tokenizer, batches):
        return ((i, tokenizer.encode(text)) for i, text in _texts(batches))

    task = _with_tokenizer(path, encode, schema, 64)
    return id_and_text(docs, id_col, text_col).mapInArrow(task, "doc_id bigint, ids array<int>")


def decode_column(tokens: DataFrame, path: str) -> DataFrame:
    """doc_id and text of the documents of ``encode_column``; null ids give an empty text."""
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string())])

    def decode(tokenizer, batches):
        return ((i, tokenizer.decode(ids or ())) for i, ids in _texts(batches))

    task = _with_tokenizer(path, decode, schema, 64)
    return tokens.select("doc_id", "ids").mapInArrow(task, "doc_id bigint, text string")


DIGESTS = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_tokens", pa.int64()),
        ("ids_sha256", pa.string()),
        ("decoded_sha256", pa.string()),
    ]
)


def digest(tokenizer: Tokenizer, text: str) -> tuple[int, str, str]:
    """Tokens, digest of the ids and digest of the decoded text, in constant memory."""
    encoder, decoder = tokenizer.encoder(), tokenizer.decoder()
    ids_sha, text_sha = hashlib.sha256(), hashlib.sha256()
    decimal, n = tokenizer.decimal, 0
    for at in range(0, len(text) + CHUNK, CHUNK):
        ids = encoder.feed(text[at : at + CHUNK]) if at < len(text) else encoder.finish()
        if ids:
            joined = ",".join(map(decimal.__getitem__, ids))
            ids_sha.update(f",{joined}".encode() if n else joined.encode())
            text_sha.update(decoder.feed(ids).encode("utf-8"))
            n += len(ids)
    text_sha.update(decoder.finish().encode("utf-8"))
    return n, ids_sha.hexdigest(), text_sha.hexdigest()


def round_trip(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Per document: doc_id, n_tokens, ids_sha256, decoded_sha256; nothing is shuffled."""

    def digests(tokenizer, batches):
        return ((i, *digest(tokenizer, text)) for i, text in _texts(batches))

    return id_and_text(docs, id_col, text_col).mapInArrow(
        _with_tokenizer(path, digests, DIGESTS),
        "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string",
    )


def op2_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return round_trip(read(spark, folder, "documents"), vocabulary_path())
