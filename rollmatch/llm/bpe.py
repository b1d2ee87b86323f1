"""Byte-level BPE: a streaming encoder with bounded lookahead and an incremental decoder.

Encoding works pre-token by pre-token. A pre-token runs through a left-to-right
transducer: the encoding of every prefix is the encoding of a shorter prefix plus one
last token, and that last token is the one whose pair with the token before it stands
(the pair encodes to itself). So one back pointer per byte of the last ``max_token``
bytes is all the state. A token is emitted as soon as it is stable, that is, as soon as
the chains of all positions that a later token can start from agree on it. Stability
sets in after ``sufficient_lookahead`` bytes at the latest (a constant of the merge
list), so memory stays constant however long a pre-token is.

Words repeat a lot; each worker keeps the ids of words in a cache of bounded size (two
generations: what was used since the last change survives it). A short pre-token is over
before its lookahead is, so its merges are applied at once.
Decoding joins the bytes of the ids and feeds them to an incremental UTF-8 state machine
(malformed bytes become U+FFFD).

Strings of special tokens inside a text become those tokens, as in the tokenizers
library with its defaults. NULL and empty texts have no ids and decode to ''.
"""

from __future__ import annotations

import codecs
import json
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rollmatch.llm.common import per_text

#: The pattern that cuts a text into pre-tokens, with white space as Unicode's White_Space.
SPACE = r"\t-\r \x85\xa0  -     　"
PATTERN = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"


def byte_alphabet() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary -> the byte."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Vocabulary:
    """Tokens and merges of a byte-level BPE file, by bytes."""

    def __init__(self, spec: dict):
        alphabet = byte_alphabet()
        as_bytes = lambda token: bytes(alphabet[c] for c in token)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.ids = {as_bytes(t): i for t, i in spec["model"]["vocab"].items() if t not in self.special}
        self.bytes = {i: b for b, i in self.ids.items()} | {i: t.encode() for t, i in self.special.items()}
        merges = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
        self.n_merges = len(merges)
        self.max_token = max(map(len, self.ids))
        self.byte_ids = [self.ids[bytes([b])] for b in range(256)]
        # left id -> right id -> rank; rank -> id of the merged token
        self.rank, self.made = [{} for _ in range(max(self.bytes) + 1)], []
        for r, (x, y) in enumerate(merges):
            x, y = as_bytes(x), as_bytes(y)
            self.rank[self.ids[x]][self.ids[y]] = r
            self.made.append(self.ids[x + y])
        none = self.n_merges
        self.byte_rank = [[self.rank[x].get(y, none) for y in self.byte_ids] for x in self.byte_ids]
        self._closed: dict[bytes, bool] = {}
        # last byte -> lengths of the tokens that end in it, longest first
        ends: dict[int, set] = {}
        for t in self.ids:
            ends.setdefault(t[-1], set()).add(len(t))
        self.lengths = [sorted(ends.get(b, ()), reverse=True) for b in range(256)]

    @property
    def sufficient_lookahead(self) -> int:
        """Bytes after a token that can still change it, at most: each of the merges can hand a change
        on by one token of at most ``max_token`` bytes."""
        return self.n_merges * self.max_token

    def merge_closed(self, token: bytes) -> bool:
        """Does the merge list make this token from its own bytes?"""
        if token not in self._closed:
            self._closed[token] = len(self.merge(token)) == 1
        return self._closed[token]

    def merge(self, data: bytes) -> list[int]:
        """Ids of a short byte string: join the best-ranked pair, leftmost first, until none is left."""
        table, byte_ids, rank, none = self.byte_rank, self.byte_ids, self.rank, self.n_merges
        parts, ranks = [byte_ids[b] for b in data], [table[x][y] for x, y in zip(data, data[1:])]
        while ranks:
            best = min(ranks)
            if best == none:
                break
            i, new = ranks.index(best), self.made[best]
            parts[i:i + 2] = [new]
            del ranks[i]
            if i:
                ranks[i - 1] = rank[parts[i - 1]].get(new, none)
            if i < len(ranks):
                ranks[i] = rank[new].get(parts[i + 1], none)
        return parts


class Transducer:
    """Left-to-right encoder of a byte stream; ``feed`` yields tokens once they are stable."""

    def __init__(self, vocabulary: Vocabulary, pairs: dict | None = None):
        self.v, self.pairs = vocabulary, {} if pairs is None else pairs
        self.window = b""            # the last max_token bytes
        self.at = 0                  # bytes read
        self.last = {0: b""}         # position -> last token of the prefix that ends there
        self.emitted = 0             # position up to which tokens are out

    def stands(self, a: bytes, b: bytes) -> bool:
        """Do the tokens a, b stay apart when their bytes are encoded together?"""
        if not a:
            return True
        key = (a, b)
        if key not in self.pairs:
            if len(self.pairs) > 200_000:
                self.pairs.clear()
            self.pairs[key] = self.v.merge(a + b) == [self.v.ids[a], self.v.ids[b]]
        return self.pairs[key]

    def feed(self, data: bytes):
        v = self.v
        for i in range(len(data)):
            self.window = (self.window + data[i:i + 1])[-v.max_token:]
            self.at += 1
            room = min(len(self.window), self.at - self.emitted)
            for n in v.lengths[data[i]]:
                if n > room:
                    continue
                token, before = self.window[-n:], self.last.get(self.at - n)
                if before is not None and token in v.ids and v.merge_closed(token) and self.stands(before, token):
                    self.last[self.at] = token
                    break
            if self.at % v.max_token == 0:
                yield from self._stable()

    def _chain(self, end: int) -> list[int]:
        ends = []
        while end > self.emitted:
            ends.append(end)
            end -= len(self.last[end])
        return ends[::-1]

    def _stable(self):
        """Emits what the chains of all live positions share."""
        live = [p for p in range(max(self.emitted, self.at - self.v.max_token + 1), self.at + 1) if p in self.last]
        shared = None
        for p in live:
            ends = self._chain(p)
            if shared is None:
                shared = ends
            else:
                k = 0
                while k < min(len(shared), len(ends)) and shared[k] == ends[k]:
                    k += 1
                shared = shared[:k]
        for end in shared or []:
            yield self.last[end]
            self.emitted = end
        self.last = {p: t for p, t in self.last.items() if p >= min(self.emitted, self.at - self.v.max_token)}

    def close(self):
        for end in self._chain(self.at):
            yield self.last[end]
        self.emitted = self.at


#: A space with white space before or after it: there the words between spaces are not independent.
UNEVEN = re.compile(r" (?:\s|(?<=\s.))")


#: Below this character, letters are the same in every version of Unicode.
LATIN_END = "\u0250"


class Encoder:
    """Text -> ids as little-endian unsigned 32-bit integers.

    A new pre-token starts at every space that stands between two characters that are
    not white space, so the stretches between such spaces are looked up as wholes.
    """

    def __init__(self, vocabulary: Vocabulary, cache_size: int = 200_000, short: int = 64):
        import regex

        self.v, self.most, self.short = vocabulary, cache_size, short
        self.find = regex.compile(PATTERN).findall
        special = sorted(self.v.special, key=len, reverse=True)
        self.special = regex.compile("(" + "|".join(map(regex.escape, special)) + ")") if special else None
        self.pack = [i.to_bytes(4, "little") for i in range(max(self.v.bytes) + 1)]
        self.words = _Words(self.encode_word, cache_size)
        self.pairs: dict = {}

    def encode_pretoken(self, piece: str) -> bytes:
        data = piece.encode("utf-8", "surrogatepass")
        if len(data) <= self.short:
            return b"".join([self.pack[i] for i in self.v.merge(data)])
        stream, out = Transducer(self.v, self.pairs), []
        for i in range(0, len(data), 4096):
            out.extend(self.pack[self.v.ids[t]] for t in stream.feed(data[i:i + 4096]))
        out.extend(self.pack[self.v.ids[t]] for t in stream.close())
        return b"".join(out)

    def encode_plain(self, text: str) -> bytes:
        return b"".join(map(self.encode_pretoken, self.find(text)))

    def encode_word(self, word: str) -> bytes:
        """Ids of a word that follows a space."""
        if word.isalpha() and max(word) < LATIN_END:
            return self.encode_pretoken(" " + word)
        if len(word) > 1 and word[-1] in ".," and word[-2].isalpha():
            return self.words[word[:-1]] + self.pack[self.v.ids[word[-1].encode()]]
        return self.encode_plain(" " + word)

    def encode_words(self, text: str) -> bytes:
        if not text or text[0].isspace() or text[-1].isspace() or UNEVEN.search(text):
            return self.encode_plain(text)
        first, *rest = text.split(" ")
        return self.encode_plain(first) + b"".join(map(self.words.__getitem__, rest))

    def __call__(self, text: str) -> bytes:
        if not any(s in text for s in self.v.special):
            return self.encode_words(text)
        return b"".join(self.pack[self.v.special[part]] if part in self.v.special else self.encode_words(part)
                        for part in self.special.split(text))


class _Words(dict):
    """Ids of words, short ones kept: ``most`` new ones, and the generation before them."""

    def __init__(self, encode, most: int):
        super().__init__()
        self.encode, self.most, self.before = encode, most // 2, {}

    def __missing__(self, word: str) -> bytes:
        ids = self.before.get(word)
        if ids is None:
            ids = self.encode(word)
            if len(word) > 64:
                return ids
        if len(self) >= self.most:
            self.before = dict(self)
            self.clear()
        self[word] = ids
        return ids


class Decoder:
    """Ids -> text: bytes of each id through an incremental UTF-8 state machine."""

    def __init__(self, vocabulary: Vocabulary):
        self.bytes = vocabulary.bytes

    def __call__(self, ids: bytes, block: int = 65_536) -> str:
        import numpy as np

        state, out, numbers = codecs.getincrementaldecoder("utf-8")("replace"), [], np.frombuffer(ids, "<u4")
        for i in range(0, len(numbers), block):
            out.append(state.decode(b"".join(map(self.bytes.__getitem__, numbers[i:i + block].tolist()))))
        out.append(state.decode(b"", True))
        return "".join(out)


def _workers(spark, tokenizer_file: str, cache_size: int):
    """A function that gives a task its worker's encoder and decoder; they last from task to task."""
    with open(tokenizer_file, encoding="utf-8") as f:
        shared = spark.sparkContext.broadcast({"file": f.read()})  # bounded by the tokenizer file

    def pair():
        held = shared.value
        if "pair" not in held:
            v = Vocabulary(json.loads(held["file"]))
            held["pair"] = Encoder(v, cache_size), Decoder(v)
        return held["pair"]

    return pair


def encode_documents(docs: DataFrame, tokenizer_file: str, id_col: str = "doc_id", text_col: str = "text",
                     cache_size: int = 200_000, decoded: bool = False) -> DataFrame:
    """Per row: id, ``ids`` (binary, little-endian unsigned 32-bit), ``n_tokens``; with ``decoded`` also ``text``, the
    text that the decoder makes of the ids in the same pass."""
    pair = _workers(docs.sparkSession, tokenizer_file, cache_size)

    def make():
        encode, decode = pair()
        if not decoded:
            return lambda t: (encode(t),)

        def both(t: str):
            ids = encode(t)
            return ids, decode(ids)

        return both

    coded = docs.select(F.col(id_col), per_text(make, "ids binary, text string" if decoded else "ids binary")(F.col(text_col)).alias("r"))
    return coded.select(id_col, "r.*").withColumn("n_tokens", (F.octet_length("ids") / 4).cast("long"))


def decode_documents(coded: DataFrame, tokenizer_file: str, ids_col: str = "ids", as_col: str = "text") -> DataFrame:
    """All columns plus the text of a binary column of ids (NULL and empty: '')."""
    pair = _workers(coded.sparkSession, tokenizer_file, 0)

    def make():
        decode = pair()[1]
        return lambda ids: (decode(bytes(ids) if ids else b""),)

    return coded.withColumn(as_col, per_text(make, "text string")(F.col(ids_col))["text"])
