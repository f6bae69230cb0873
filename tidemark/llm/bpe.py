"""Byte-pair encoding as a streaming transducer with bounded lookahead, and decoding.

The merge list fixes how far to the right of a place the text can change the tokens to its left
(:func:`sufficient_lookahead`). A run of any length is therefore encoded through a window: tokens
that end further than the lookahead before the window's end are final, are emitted, and leave the
window. Beyond the text itself the state has a constant size, and time is in proportion to the text, also where a run of
a million characters has no white space. (A merge list without a bound leaves no token final before its run ends.)

Two forms of tokenizer files are understood: byte level (no normaliser, the usual splitting pattern)
and word level (NFC, white space to one space, lower case; words end in a suffix). Ids are those of
the ``tokenizers`` library without special tokens added, truncation and padding; the text of a
special token in a document gives its id.

Defined cases: a null text counts as empty and has no ids; repeated rows give repeated rows; an empty
table gives an empty table; columns that are not asked for are dropped, so clashing names don't matter.
"""

from __future__ import annotations

import codecs
import heapq
import json
import re
import unicodedata
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tasks import map_batches, slices

#: Entries of a worker's table of words; it starts anew when full, which only costs time.
MEMO_WORDS = 500_000
#: Longest stretch that is looked up as one word, in characters.
LONG_WORD = 200
#: Characters that are normalised at a time.
BLOCK = 1 << 16
#: Characters of a run that are encoded at a time, at least.
WINDOW = 4096
#: Tokens from which on merges are found by a heap: n log n instead of a pass for each merge.
HEAP_FROM = 48

# The splitting pattern of byte-level tokenizers.
BYTE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    return [chr(b if b in plain else next(others)) for b in range(256)]


def sufficient_lookahead(merges: list[tuple[str, str]], length) -> int | None:
    """Symbols to the right of a place that can still change the tokens to its left.

    Take two texts with a common beginning. While the merges run, the tokens left of a frontier are
    the same in both; at first the frontier is the end of the common part. Only a merge (u, v) across
    the frontier in one of them moves it, by ``length(u)``, and from then on the token at the frontier
    starts with u. The next move therefore is by a later merge (u', v') where u is on the left spine
    of v'. The longest such chain is the lookahead. ``None``: some token's merge comes after a merge
    that uses the token, so merges don't run in the list's order and no bound follows.
    """
    made: dict[str, int] = {}
    lefts: dict[str, set[str]] = {}
    for rank, (left, right) in enumerate(merges):
        made[left + right] = rank
        lefts.setdefault(left + right, set()).add(left)
    if any(made.get(part, -1) >= rank for rank, pair in enumerate(merges) for part in pair):
        return None
    best: dict[str, int] = {}
    longest = 0
    for left, right in reversed(merges):
        reach = length(left) + best.get(left, 0)
        longest = max(longest, reach)
        spine, seen = [right], {right}
        while spine:
            token = spine.pop()
            if best.get(token, 0) < reach:
                best[token] = reach
            for child in lefts.get(token, ()):
                if child not in seen:
                    seen.add(child)
                    spine.append(child)
    return longest


class Vocabulary:
    """What a tokenizer file says: merges, ids, special tokens, kind of text splitting."""

    def __init__(self, spec: dict):
        model = spec["model"]
        if model.get("type") != "BPE" or model.get("dropout") or model.get("continuing_subword_prefix") or model.get("byte_fallback") or model.get("ignore_merges"):
            raise ValueError("not a plain BPE model")
        self.suffix: str = model.get("end_of_word_suffix") or ""
        self.ids: dict[str, int] = model["vocab"]
        self.pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.by_word, self.pattern = self._kind(spec)
        self.joined = spec.get("decoder") is None
        self.alphabet = byte_alphabet()
        self.width = max([*self.ids.values(), *self.special.values()]) + 1
        size = len(self.suffix)
        self.lookahead = sufficient_lookahead(
            self.pairs, lambda t: len(t) - size if size and t.endswith(self.suffix) else len(t)
        )
        #: The rank and the result of a merge by its two ids in one number.
        self.rank = {self.ids[a] * self.width + self.ids[b]: r for r, (a, b) in enumerate(self.pairs)}
        self.made = [self.ids[a + b] for a, b in self.pairs]
        self.inner = [self.ids[c] for c in self.alphabet]
        self.final = [self.ids[c + self.suffix] for c in self.alphabet]
        self.names = [""] * self.width
        for table in (self.ids, self.special):
            for name, token in table.items():
                self.names[token] = name

    @staticmethod
    def _kind(spec: dict) -> tuple[bool, str]:
        normalizer, splitter = spec.get("normalizer"), spec.get("pre_tokenizer") or {}
        if normalizer is None and splitter.get("type") == "ByteLevel" and splitter.get("use_regex") and not splitter.get("add_prefix_space"):
            return False, BYTE_PATTERN
        steps = [(s["type"], s.get("content"), (s.get("pattern") or {}).get("Regex")) for s in (normalizer or {}).get("normalizers", [])]
        parts = splitter.get("pretokenizers", [])
        if steps == [("NFC", None, None), ("Replace", " ", r"\s+"), ("Lowercase", None, None)] and [p["type"] for p in parts] == ["Split", "ByteLevel"] and parts[0]["behavior"] == "Removed" and parts[0]["invert"]:
            return True, parts[0]["pattern"]["Regex"]
        raise ValueError("neither a byte-level nor a word-level tokenizer file")


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit integers."""

    def __init__(self, vocabulary: Vocabulary, window: int = WINDOW, block: int = BLOCK):
        self.v = vocabulary
        self.block = block
        self.window = max(window, 2 * (vocabulary.lookahead or 0) + 8)
        self.pieces = regex.compile(vocabulary.pattern)
        names = sorted(vocabulary.special, key=len, reverse=True)
        self.specials = re.compile("|".join(map(re.escape, names))) if names else None
        self.memo: dict[str, bytes] = {}

    # Merges

    def _merged(self, tokens: list[int]) -> list[int]:
        if len(tokens) > HEAP_FROM:
            return self._merged_by_heap(tokens)
        width, rank, made = self.v.width, self.v.rank.get, self.v.made
        none = len(made)
        ranks = [rank(a * width + b, none) for a, b in zip(tokens, tokens[1:])]
        while ranks:
            first = min(ranks)
            if first == none:
                break
            at = ranks.index(first)
            tokens[at : at + 2] = [made[first]]
            del ranks[at]
            if at < len(ranks):
                ranks[at] = rank(tokens[at] * width + tokens[at + 1], none)
            if at:
                ranks[at - 1] = rank(tokens[at - 1] * width + tokens[at], none)
        return tokens

    def _merged_by_heap(self, tokens: list[int]) -> list[int]:
        """The same for many tokens: the next merge from a heap of (rank, place), tokens as a linked list."""
        width, rank, made = self.v.width, self.v.rank.get, self.v.made
        size = len(tokens)
        after, before = list(range(1, size + 1)), list(range(-1, size - 1))
        heap = [(r, k) for k, r in enumerate(rank(a * width + b, -1) for a, b in zip(tokens, tokens[1:])) if r >= 0]
        heapq.heapify(heap)
        while heap:
            first, at = heapq.heappop(heap)
            right = after[at]
            # An entry is out of date if its token is gone or its pair has changed.
            if right >= size or tokens[at] < 0 or rank(tokens[at] * width + tokens[right], -1) != first:
                continue
            tokens[at], tokens[right] = made[first], -1
            following = after[at] = after[right]
            if following < size:
                before[following] = at
                r = rank(tokens[at] * width + tokens[following], -1)
                if r >= 0:
                    heapq.heappush(heap, (r, at))
            previous = before[at]
            if previous >= 0:
                r = rank(tokens[previous] * width + tokens[at], -1)
                if r >= 0:
                    heapq.heappush(heap, (r, previous))
        return [t for t in tokens if t >= 0]

    def _word(self, word: str) -> bytes:
        """Ids of a short stretch of text that no other text changes."""
        if not word:
            return b""
        body = word if self.v.by_word else word[1:]
        if body.isalpha() and (self.v.by_word or word[0] == " "):
            return array("I", self._piece(word)).tobytes()
        if word[-1] in ",." and body[:-1].isalpha() and (self.v.by_word or word[0] == " "):
            known = self.memo.get(word[:-1]) or array("I", self._piece(word[:-1])).tobytes()
            return known + self._mark(word[-1])
        return array("I", [t for p in self.pieces.findall(word) for t in self._piece(p)]).tobytes()

    def _mark(self, char: str) -> bytes:
        return array("I", self._piece(char)).tobytes()

    def _piece(self, piece: str, ended: bool = True) -> list[int]:
        data = piece.encode()
        tokens = list(map(self.v.inner.__getitem__, data))
        if ended:
            tokens[-1] = self.v.final[data[-1]]
        return self._merged(tokens)

    def _stable(self, run: str) -> tuple[list[int], str]:
        """Final tokens of an unfinished run, and the rest of the run."""
        if self.v.lookahead is None:
            return [], run
        tokens = self._piece(run, ended=False)
        borders, at = {0}, 0
        starts = {}
        for index, char in enumerate(run):
            at += len(char.encode())
            borders.add(at)
            starts[at] = index + 1
        limit, done, cut, place = at - self.v.lookahead - 4, 0, 0, 0
        size = len(self.v.suffix)
        for count, token in enumerate(tokens, 1):
            name = self.v.names[token]
            done += len(name) - size if size and name.endswith(self.v.suffix) else len(name)
            if done > limit:
                break
            if done in borders:
                cut, place = count, starts[done]
        return tokens[:cut], run[place:]

    def _scan(self, text: str, out: list[bytes], closed: bool) -> str:
        """Encode the pieces of ``text``; if more text follows, return what it can still change."""
        matches = self.pieces.finditer(text)
        held: list = []
        for match in matches:
            held.append(match)
            if not closed:
                # What follows can change the last match, and an apostrophe some characters before.
                while len(held) > 1 and held[-1].end() - held[1].start() >= 4:
                    self._emit(held.pop(0).group(), out)
            else:
                self._emit(held.pop().group(), out)
        if closed or not held:
            return ""
        while len(held) > 1 and len(held[-1].group()) > self.window:
            self._emit(held.pop(0).group(), out)
        rest = text[held[0].start() :]
        return self._windows(rest, out) if len(held) == 1 else rest

    def _windows(self, run: str, out: list[bytes]) -> str:
        """Emit the final tokens of an unfinished run, window by window; what is left is no longer than a window."""
        start = 0
        while len(run) - start > self.window and self.v.lookahead is not None:
            window = run[start : start + self.window]
            tokens, rest = self._stable(window)
            if not tokens:
                break
            out.append(array("I", tokens).tobytes())
            start += len(window) - len(rest)
        return run[start:]

    def _emit(self, piece: str, out: list[bytes]) -> None:
        piece = self._windows(piece, out)
        if piece:
            out.append(array("I", self._piece(piece)).tobytes())

    # Texts

    def _blocks(self, text: str) -> Iterator[tuple[str, bool]]:
        """The text in blocks, and whether nothing that follows changes a block's tokens."""
        start = 0
        while len(text) - start > self.block:
            stop = start + self.block
            near = text[start:stop]
            cut, closed = 0, True
            if self.v.by_word:
                cut = next((p for p in range(len(near) - 1, 0, -1) if near[p].isspace() and not CONTROLS.match(near[p])), 0)
            else:
                cut = next((p for p in range(len(near) - 2, 0, -1) if near[p] == " " and not near[p - 1].isspace() and not near[p + 1].isspace()), 0)
            if not cut:
                closed = False
                # Below U+0300 and in the ideographs no character composes with the one before it.
                cut = next((p for p in range(len(near) - 1, 0, -1) if near[p] < "̀" or "一" <= near[p] < "ꀀ"), 0)
            if not cut:
                break
            yield near[:cut], closed
            start += cut
        yield text[start:], True

    def _normal(self, text: str) -> str:
        if self.v.by_word:
            text = unicodedata.normalize("NFC", text)
            # One character at a time, so a sigma has one lower form wherever it stands.
            text = text.replace("Σ", "σ").lower()
        return text

    def _words(self, text: str) -> list[str]:
        if not self.v.by_word:
            first, *others = BETWEEN_WORDS.split(text)
            return [first, *[" " + w for w in others]] if first or others else []
        return regex.split(r"\s+", text) if CONTROLS.search(text) else text.split()

    def _ordinary(self, text: str, out: list[bytes]) -> None:
        memo, carry = self.memo, ""
        for block, closed in self._blocks(text):
            block = carry + self._normal(block)
            if not closed or carry:
                carry = self._scan(block, out, closed)
                continue
            words = self._words(block)
            if len(memo) >= MEMO_WORDS:
                memo.clear()
            long = []
            for word in set(words).difference(memo):
                if len(word) <= LONG_WORD:
                    memo[word] = self._word(word)
                else:
                    long.append(word)
            if long:
                for word in words:
                    if len(word) <= LONG_WORD:
                        out.append(memo[word])
                    else:
                        self._scan(word, out, True)
            else:
                out.append(b"".join(map(memo.__getitem__, words)))

    def encode(self, text: str | None) -> bytes:
        if not text:
            return b""
        out: list[bytes] = []
        if self.specials is None or "<" not in text:
            self._ordinary(text, out)
        else:
            at = 0
            for found in self.specials.finditer(text):
                self._ordinary(text[at : found.start()], out)
                out.append(array("I", [self.v.special[found.group()]]).tobytes())
                at = found.end()
            self._ordinary(text[at:], out)
        return b"".join(out)


#: A space between two other characters, where no token of a byte-level tokenizer continues.
BETWEEN_WORDS = re.compile(r"(?<=\S) (?=\S)")
#: Characters that only Python counts as white space.
CONTROLS = re.compile(r"[\x1c-\x1f]")


class Decoder:
    """Text of ids, fed in portions: the state is an unfinished character or whether a token came before.

    Byte-level tokens give the text they were made from; bytes that are no UTF-8 become U+FFFD.
    Without a decoder in the file the tokens' names are joined by spaces, as the library does.
    """

    def __init__(self, vocabulary: Vocabulary):
        self.names = vocabulary.names
        self.joined = vocabulary.joined
        code = {c: b for b, c in enumerate(vocabulary.alphabet)}
        self.data = [] if self.joined else [bytes(code[c] for c in n) if all(c in code for c in n) else n.encode() for n in self.names]
        self.reset()

    def reset(self) -> None:
        self.begun = False
        self.partial = codecs.getincrementaldecoder("utf-8")("replace")

    def feed(self, ids: list[int], last: bool = False) -> str:
        if not self.joined:
            return self.partial.decode(b"".join(map(self.data.__getitem__, ids)), last)
        text = " ".join(map(self.names.__getitem__, ids))
        if self.begun and ids:
            text = " " + text
        self.begun = self.begun or bool(ids)
        return text

    def decode(self, data: bytes, portion: int = 1 << 16) -> str:
        """Text of ids stored as little-endian unsigned 32-bit integers."""
        self.reset()
        ids = np.frombuffer(data, "<u4")
        parts = [self.feed(ids[k : k + portion].tolist()) for k in range(0, len(ids), portion)]
        return "".join([*parts, self.feed([], True)])


@lru_cache(maxsize=4)
def _tools(path: str) -> tuple[Encoder, Decoder]:
    with open(path, encoding="utf-8") as file:
        vocabulary = Vocabulary(json.load(file))
    return Encoder(vocabulary), Decoder(vocabulary)


def encode_texts(df: DataFrame, path: str, key: str = "doc_id", text: str = "text", decode: bool = False) -> DataFrame:
    """``key``, ``n_tokens`` and ``ids`` (little-endian unsigned 32 bits) of each row, in one pass over the rows.

    With ``decode`` also ``decoded``, the text that the ids give. ``path`` names a tokenizer file that
    all executors have.
    """

    def encoded(batches):
        encoder, decoder = _tools(path)
        for batch in slices(batches):
            ids = [encoder.encode(t) for t in batch.column(1).to_pylist()]
            columns = [batch.column(0), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(ids, pa.binary())]
            if decode:
                columns.append(pa.array([decoder.decode(x) for x in ids], pa.string()))
            yield pa.RecordBatch.from_arrays(columns, names[: len(columns)])

    rows = df.select(F.col(key).alias("key"), F.col(text).cast("string").alias("value"))
    names = ["key", "n_tokens", "ids", "decoded"]
    schema = f"key {rows.schema['key'].dataType.simpleString()}, n_tokens bigint, ids binary" + ", decoded string" * decode
    return map_batches(rows, encoded, schema).withColumnRenamed("key", key)


def decode_ids(df: DataFrame, path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """``key`` and the ``decoded`` text of each row's ids; null ids count as none."""

    def decoded(batches):
        decoder = _tools(path)[1]
        for batch in slices(batches):
            texts = [decoder.decode(x or b"") for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["key", "decoded"])

    rows = df.select(F.col(key).alias("key"), F.col(ids).alias("value"))
    return map_batches(rows, decoded, f"key {rows.schema['key'].dataType.simpleString()}, decoded string").withColumnRenamed("key", key)
