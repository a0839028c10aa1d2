"""Byte-pair encoding and decoding as a streaming transducer with a bounded lookahead.

A merge list has a sufficient lookahead: a number of bytes such that no text that
follows can change the tokens that end at least so far before the end of what has
been read. The encoder keeps one block and the lookahead in memory, merges that
window, emits the tokens that are stable and goes on behind them.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import json
from array import array
from collections.abc import Iterable, Iterator
from itertools import batched, chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from worklink.llm.common import Recent, id_and_text, per_text

#: Fixed value: the pattern that cuts text into pieces before byte-level merges.
PIECES = regex.compile(r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+""")

INNER_BLANK = regex.compile(r"\s \s")
DIGEST = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])


def byte_characters() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def sufficient_lookahead(merges: list[tuple[bytes, bytes]]) -> int:
    """Bytes after which a token is stable, from the merge list alone.

    Compare the merging of a text with that of a longer one. Left of a frontier
    both hold the same symbols; it starts at the end of the shorter text. It moves
    only when a merge (u, v) joins the last common symbol u to a symbol v that
    begins at the frontier in one of the two, and then by the length of u. The
    next such merge has a later rank (one rank is applied from the left, so it
    moves the frontier once), and its right symbol begins with u: u lies on that
    symbol's left spine. The bound is the heaviest chain of merges of this kind.
    """
    reach: dict[bytes, int] = {}
    made: dict[bytes, list[bytes]] = {}

    def behind(symbol: bytes) -> int:
        best, todo, seen = 0, [symbol], set()
        while todo:
            s = todo.pop()
            if s not in seen:
                seen.add(s)
                best = max(best, reach.get(s, 0))
                todo += made.get(s, ())
        return best

    for left, right in merges:
        length = len(left) + behind(right)
        reach[left] = max(reach.get(left, 0), length)
        made.setdefault(left + right, []).append(left)
    return max(reach.values(), default=0)


def merge(symbols: list[int], ranks: dict[tuple[int, int], int], made: list[int]) -> list[int]:
    """Apply a merge list to a list of symbols: the lowest rank first, the leftmost of equals first.

    `ranks` gives the rank of a pair, `made` the symbol that the merge of a rank makes.
    """
    rank, never = ranks.get, len(made)
    if len(symbols) <= 64:
        found = [rank(pair, never) for pair in zip(symbols, symbols[1:])]
        while found:
            best = min(found)
            if best == never:
                break
            i = found.index(best)
            new = symbols[i] = made[best]
            del symbols[i + 1], found[i]
            if i:
                found[i - 1] = rank((symbols[i - 1], new), never)
            if i < len(found):
                found[i] = rank((new, symbols[i + 1]), never)
        return symbols
    n = len(symbols)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    queue = [(rank(p), i, p) for i, p in enumerate(zip(symbols, symbols[1:])) if rank(p) is not None]
    heapq.heapify(queue)
    while queue:
        best, i, pair = heapq.heappop(queue)
        j = after[i]
        if symbols[i] is None or j >= n or (symbols[i], symbols[j]) != pair:
            continue
        symbols[i], symbols[j] = made[best], None
        after[i] = after[j]
        if after[j] < n:
            before[after[j]] = i
        for a, b in ((before[i], i), (i, after[i])):
            if a >= 0 and b < n and (r := rank((symbols[a], symbols[b]))) is not None:
                heapq.heappush(queue, (r, a, (symbols[a], symbols[b])))
    return [s for s in symbols if s is not None]


class BytePairCoder:
    """Encoder and decoder of one byte-level vocabulary file (its JSON text)."""

    def __init__(self, spec: str, block: int = 4096):
        spec = json.loads(spec)
        of = byte_characters()
        raw = {token: bytes(of[c] for c in token) if all(c in of for c in token) else token.encode()
               for token in spec["model"]["vocab"]}
        ids = {raw[token]: i for token, i in spec["model"]["vocab"].items()}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        merges = [(raw[a], raw[b]) for a, b in pairs]
        self.of_byte = [ids[bytes([b])] for b in range(256)]
        self.rank = {(ids[a], ids[b]): r for r, (a, b) in reversed(list(enumerate(merges)))}
        self.made = [ids[a + b] for a, b in merges]  # by rank
        self.bytes_of = {i: b for b, i in ids.items()}
        # added tokens are found in the text before anything else
        self.added = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.bytes_of.update({i: content.encode() for content, i in self.added.items()})
        self.shown = {i: str(i) for i in self.bytes_of}
        self.lookahead = sufficient_lookahead(merges)
        self.block = max(block, *map(len, self.bytes_of.values()))
        self.__setstate__({})

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k not in ("parts", "forms")}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self.parts, self.forms = Recent(self.encode_part, limit=400_000), Recent(self.form, limit=400_000)

    def merged(self, data: bytes) -> list[int]:
        """Tokens of a window."""
        return merge([self.of_byte[b] for b in data], self.rank, self.made)

    def stream(self, chunks: Iterable[bytes]) -> Iterator[int]:
        """The transducer: tokens of one piece that arrives in chunks of any size."""
        window = b""
        for chunk in chunks:
            window += chunk
            while len(window) > self.lookahead + 2 * self.block:
                head = window[:self.lookahead + self.block]
                stable, end = len(head) - self.lookahead, 0
                for token in self.merged(head):
                    if end + len(self.bytes_of[token]) > stable:
                        break
                    end += len(self.bytes_of[token])
                    yield token
                window = window[end:]
        yield from self.merged(window)  # the piece has ended: all is stable

    def piece(self, piece: str) -> bytes:
        """Ids of one piece, four bytes each."""
        data = piece.encode()
        if len(data) <= self.block:
            return array("I", self.merged(data)).tobytes()
        return array("I", self.stream(data[i:i + self.block] for i in range(0, len(data), self.block))).tobytes()

    def encode_part(self, part: str) -> bytes:
        """Ids of an added token or of text without any; a word after a blank is one piece."""
        if part in self.added:
            return array("I", [self.added[part]]).tobytes()
        if part[1:].isalpha() and (part[0] == " " or part[0].isalpha()):
            return self.piece(part)
        pieces = PIECES.findall(part)
        return self.piece(part) if len(pieces) == 1 else b"".join([self.parts[p] for p in pieces])

    def form(self, part: str) -> tuple[bytes, bytes]:
        """The ids of a part as decimal numbers, a comma before each, and the bytes that they stand for."""
        tokens = array("I", self.encode_part(part))
        return "".join(["," + self.shown[t] for t in tokens]).encode(), b"".join([self.bytes_of[t] for t in tokens])

    def split_added(self, text: str) -> list[str]:
        """Text and added tokens in turn; the leftmost, then the longest token counts."""
        if not any(content in text for content in self.added):
            return [text]
        found = "|".join(regex.escape(c) for c in sorted(self.added, key=len, reverse=True))
        return regex.split(f"({found})", text)

    def encoded(self, text: str, memo: Recent) -> Iterator[list]:
        """What a memo holds of a text's parts: cut at blanks where no piece crosses the cut, else piece by piece.

        A piece begins at a blank unless that blank stands inside a run of white space.
        """
        for i, part in enumerate(self.split_added(text)):
            if i % 2:
                yield [memo[part]]
            elif part and INNER_BLANK.search(part):
                for pieces in batched(PIECES.finditer(part), 4096):
                    yield [memo[p.group()] for p in pieces]
            elif part:
                words = part.split(" ")
                if words[0]:
                    yield [memo[words[0]]]
                for at in range(1, len(words), 4096):
                    yield [memo[" " + w] for w in words[at:at + 4096]]

    def encode(self, text: str) -> list[int]:
        return array("I", b"".join(chain.from_iterable(self.encoded(text, self.parts)))).tolist()

    def decode(self, tokens: Iterable[int]) -> Iterator[str]:
        """Text of a token stream; bytes of an unfinished character wait for the next token."""
        machine = codecs.getincrementaldecoder("utf-8")("replace")
        for token in tokens:
            if out := machine.decode(self.bytes_of[token]):
                yield out
        if out := machine.decode(b"", True):
            yield out

    def digest(self, text: str) -> tuple[int, str, str]:
        """Number of tokens, digest of the ids, digest of the decoded text."""
        ids, out = hashlib.sha256(), hashlib.sha256()
        machine, n = codecs.getincrementaldecoder("utf-8")("replace"), 0
        for forms in self.encoded(text, self.forms):
            shown = b"".join([f[0] for f in forms])
            ids.update(shown if n else shown[1:])
            out.update(machine.decode(b"".join([f[1] for f in forms])).encode())
            n += shown.count(b",")
        out.update(machine.decode(b"", True).encode())
        return n, ids.hexdigest(), out.hexdigest()


def bpe_roundtrip(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and decode every whole text: n_tokens, ids_sha256, decoded_sha256 per row.

    `vocabulary` is the path of a byte-level BPE file, read on the driver and sent
    to the executors. A null text is empty; an empty text has no tokens and the
    digests of empty strings. Repeated rows give repeated results, a null id stays
    null, other columns are not read. Very long texts and pieces pass through the
    transducer window by window.
    """
    with open(vocabulary, encoding="utf-8") as file:
        coder = docs.sparkSession.sparkContext.broadcast(BytePairCoder(file.read()))

    def run(batches):
        yield from per_text(coder.value.digest, DIGEST)(batches)

    return id_and_text(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
