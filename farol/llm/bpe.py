"""Byte-level BPE as a streaming transducer with bounded lookahead, and an incremental byte-to-text decoder.

A merge (u, v) at some place can be prevented from the right only by a merge of higher priority that takes away the end of
v, that merge only by one of still higher priority further right, and so on. The priorities fall along such a chain, so its
longest length in bytes, computed once from the merge list, is a sufficient lookahead: a token that ends that far before
the end of the buffer cannot change. The encoder buffers one window, emits its stable tokens and goes on after them; the
part of the state that grows with the text is none.

A null text is an empty text. Texts are cut before a single space between visible characters, which is always a border of
the pre-tokenizer's pattern, so no text of any length is held as a list of words.
"""

from __future__ import annotations

import codecs
import hashlib
import heapq
import json
import re
from array import array
from collections.abc import Iterable, Iterator

import regex
from pyspark.sql import DataFrame

from farol.llm import kit


def pattern(letter: str, number: str, space: str) -> str:
    """Fixed form: how the public byte-level tokenizer parts words, with the three classes of characters to be filled in."""
    return rf"'s|'t|'re|'ve|'m|'ll|'d| ?[{letter}]+| ?[{number}]+| ?[^{space}{letter}{number}]+|[{space}]+(?![^{space}])|[{space}]+"


#: Characters of a text that are split into words at once.
SEGMENT = 1 << 18
#: Words whose tokens a worker remembers; when the memory is full it becomes the older one, and the one before that goes.
WORDS = 1 << 18
#: Up to this many bytes the tokens of a word are remembered, and `merge` looks at all pairs again after each merge.
SHORT = 64
#: The low half of a rule's code is the token it makes, the high half its priority.
MADE = (1 << 32) - 1


def byte_letters() -> dict[str, int]:
    """The printable stand-in of every byte in the vocabulary file: itself where printable, else the next letter from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + i): b for i, b in enumerate(hidden)}


class Merges:
    """The merge list by token numbers, the bytes of every token, and the sufficient lookahead."""

    def __init__(self, text: str):
        spec = json.loads(text)
        letters, model = byte_letters(), spec["model"]
        vocabulary: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.bytes = [b""] * (1 + max([*vocabulary.values(), *self.special.values()]))
        for token, i in vocabulary.items():
            self.bytes[i] = bytes(letters[c] for c in token)
        for token, i in self.special.items():
            self.bytes[i] = token.encode()
        self.single = [vocabulary[c] for c, _ in sorted(letters.items(), key=lambda x: x[1])]
        self.rules: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.rules[vocabulary[a], vocabulary[b]] = (rank, vocabulary[a + b])
        self.codes = {pair: rank << 32 | made for pair, (rank, made) in self.rules.items()}
        self.lookahead = self._lookahead()

    def _lookahead(self) -> int:
        """Longest chain of right-hand conflicts in bytes, by one pass over the rules in order of priority."""
        right: dict[int, int] = {}  # a token's right child in its first derivation
        reach: dict[int, int] = {}  # the farthest chain among earlier rules whose left token is this one
        most = 0
        for (u, v), (_, made) in sorted(self.rules.items(), key=lambda x: x[1][0]):
            spine, far = v, 0
            while True:
                far = max(far, reach.get(spine, 0))
                if spine not in right:
                    break
                spine = right[spine]
            length = len(self.bytes[u]) + len(self.bytes[v]) + far
            most = max(most, length)
            reach[u] = max(reach.get(u, 0), length)
            right.setdefault(made, v)
        return most


def merge(data: bytes, m: Merges) -> list[int]:
    """Ordinary BPE of one buffer: the merge of highest priority first, the leftmost of equals.

    Short buffers look at all pairs again after each merge; long ones keep a heap of candidates over links.
    """
    ids = [m.single[b] for b in data]
    if len(data) <= SHORT:
        find, none = m.codes.get, 1 << 62
        found = [find(pair, none) for pair in zip(ids, ids[1:])]
        while found and (best := min(found)) != none:
            i = found.index(best)
            ids[i] = made = best & MADE
            del ids[i + 1], found[i]
            if i:
                found[i - 1] = find((ids[i - 1], made), none)
            if i < len(found):
                found[i] = find((made, ids[i + 1]), none)
        return ids
    after, before = [*range(1, len(ids)), -1], [*range(-1, len(ids) - 1)]
    heap = [(r[0], i, ids[i], ids[i + 1], r[1]) for i in range(len(ids) - 1) if (r := m.rules.get((ids[i], ids[i + 1])))]
    heapq.heapify(heap)
    while heap:
        _, i, a, b, made = heapq.heappop(heap)
        j = after[i]
        if ids[i] != a or j < 0 or ids[j] != b:
            continue
        ids[i], ids[j], after[i] = made, -1, after[j]
        if after[j] >= 0:
            before[after[j]] = i
            if r := m.rules.get((made, ids[after[j]])):
                heapq.heappush(heap, (r[0], i, made, ids[after[j]], r[1]))
        if (p := before[i]) >= 0 and (r := m.rules.get((ids[p], made))):
            heapq.heappush(heap, (r[0], p, ids[p], made, r[1]))
    return [i for i in ids if i >= 0]


def transduce(chunks: Iterable[bytes], m: Merges) -> Iterator[list[int]]:
    """Tokens of the bytes between two word borders, emitted as soon as they are stable: at the border, or the lookahead before the buffer's end."""
    buffer = b""
    window = max(4096, 2 * m.lookahead)
    for chunk in chunks:
        for at in range(0, len(chunk), window):
            buffer += chunk[at:at + window]
            if len(buffer) < window + m.lookahead:
                continue
            stable, used, out = len(buffer) - m.lookahead, 0, []
            for token in merge(buffer, m):
                if used + len(m.bytes[token]) > stable:
                    break
                used += len(m.bytes[token])
                out.append(token)
            buffer = buffer[used:]
            yield out
    yield merge(buffer, m)


class Encoder(dict):
    """Bytes of the token numbers of a word, by the word. No merge crosses a word's border, so the transducer starts anew there: what it emits
    depends on the word alone and is remembered. What is missing is encoded when it is asked for."""

    def __init__(self, m: Merges):
        super().__init__()
        self.older: dict[str, bytes] = {}
        self.merges = m
        self.any = regex.compile(pattern(r"\p{L}", r"\p{N}", r"\p{White_Space}")).findall
        self.latin = re.compile(pattern("A-Za-zªµºÀ-ÖØ-öø-ÿ", "0-9²³¹¼-¾", " \t-\r\x85\xa0")).findall
        self.cut = regex.compile(r"(?<=\P{White_Space}) (?=\P{White_Space})")
        self.special = regex.compile("(" + "|".join(map(regex.escape, m.special)) + ")") if m.special else None

    def __missing__(self, word: str) -> bytes:
        data = word.encode("utf-8", "replace")
        found = self.older.get(word) or b"".join(array("I", ids).tobytes() for ids in transduce([data], self.merges))
        if len(data) <= SHORT:
            if len(self) >= WORDS:
                self.older = dict(self)
                self.clear()
            self[word] = found
        return found

    def split(self, text: str) -> list[str]:
        """The words of a text; up to U+00FF the classes are short lists of characters and the plain engine is faster."""
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self.any(text)
        return self.latin(text)

    def segments(self, text: str) -> Iterator[str]:
        start = 0
        while len(text) - start > SEGMENT:
            border = self.cut.search(text, start + SEGMENT)
            if border is None:
                break
            yield text[start:border.start()]
            start = border.start()
        yield text[start:] if start else text

    def encode(self, text: str) -> Iterator[bytes]:
        """Little-endian 32-bit token numbers, part by part."""
        for k, part in enumerate(self.special.split(text) if self.special else [text]):
            if k % 2:
                yield array("I", [self.merges.special[part]]).tobytes()
            elif part:
                for segment in self.segments(part):
                    yield b"".join(map(self.__getitem__, self.split(segment)))


class Decoder:
    """Token numbers in, text out; bytes of an unfinished character wait for the next token."""

    def __init__(self, m: Merges):
        self.table = m.bytes
        self.state = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: Iterable[int]) -> str:
        return self.state.decode(b"".join(map(self.table.__getitem__, ids)))

    def end(self) -> str:
        return self.state.decode(b"", True)


def vocabulary_text(path: str) -> str:
    """The vocabulary file, read once on the driver (a few MB, whatever the corpus) and sent along with the function."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def encode_decode(docs: DataFrame, vocabulary: str, outputs: bool = False) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) per row; with `outputs` also ids, 32-bit little-endian, and the decoded text.

    `vocabulary` is the text of a tokenizer file. Rows are independent: null and repeated ids stay as they are.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    # A worker unpacks a broadcast value once and keeps it, so tables and words of one task serve the next.
    shared = docs.sparkSession.sparkContext.broadcast({"vocabulary": vocabulary})

    def make():
        state = shared.value
        if "encoder" not in state:
            state["encoder"] = Encoder(Merges(state["vocabulary"]))
        encoder: Encoder = state["encoder"]

        def one(text: str | None):
            decoder, seen, said, n, kept, plain = Decoder(encoder.merges), hashlib.sha256(), hashlib.sha256(), 0, [], []
            for part in encoder.encode(text or ""):
                seen.update(part)
                n += len(part) // 4
                words = decoder.feed(array("I", part))
                said.update(words.encode())
                if outputs:
                    kept.append(part)
                    plain.append(words)
            last = decoder.end()
            said.update(last.encode())
            return (n, seen.hexdigest(), said.hexdigest(), *([b"".join(kept), "".join(plain) + last] if outputs else []))

        return lambda c: [c[0], *map(list, zip(*map(one, c[1])))]

    schema = f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + ", ids binary, decoded string" * outputs
    return kit.map_rows(docs.select("doc_id", "text"), schema, make, 256)
