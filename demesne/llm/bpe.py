"""Byte-pair encoding and decoding by merge ranks (operator 11).

A tokenizer file of the `tokenizers` library gives the vocabulary, the ranks of the merges and the steps
around them; the encoding itself is done here. A text is parted at special tokens, normalised, and cut into
words. The symbols of a word form a doubly linked list, and its adjacent pairs that have a rank stand in a
priority queue of (rank, place). The least is taken; if the pair at that place has changed since, the entry
is stale and skipped, else its right symbol is unlinked and the new pairs to both sides are queued: n log n
for a word of n symbols. Decoding joins vocabulary strings, as the file's decoder says (by a blank if it has none).

Words met before in a worker are looked up in a bounded table. The work is narrow: no shuffle, and no
more than a piece of the texts in memory at a time, apart from a single text that is longer.

Files understood: BPE without dropout, byte fallback or subword prefix, behind a byte-level split by a pattern; the
normalisers NFC, lower case and replacement of white space. Others raise ValueError.

Defined results: a null or empty text has no ids and decodes to the empty text; the strings of special
tokens are those tokens, wherever they stand; repeated rows are encoded each; an empty table gives no
rows; ids without a vocabulary string decode to nothing; other columns are neither read nor kept.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import sys
import unicodedata
from collections.abc import Iterable
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from demesne.llm.common import lists, per_piece

#: Words kept encoded per worker, and the length above which a word is not kept.
MEMO, MEMO_CHARS = 600_000, 64
#: Below these code points every character has been assigned for long, so all tables agree on it.
HIGH = re.compile("[\u0378-\U0010ffff]")
#: White space of patterns (fixed values): what has that property in Unicode.
_SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"

_loaded: dict[str, Tokenizer] = {}


def byte_characters() -> list[str]:
    """The printable character that stands for each byte: its own where it has one, else the next from U+0100 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return [chr(b if b in own else next(rest)) for b in range(256)]


def _ranges(kind: str, end: int) -> str:
    """The characters of a general category below a code point, as ranges of a character class."""
    runs = groupby(enumerate(c for c in range(end) if unicodedata.category(chr(c))[0] == kind), lambda p: p[1] - p[0])
    spans = [[c for _, c in run] for _, run in runs]
    return "".join(f"{chr(s[0])}-{chr(s[-1])}" for s in spans)


def _steps(part: dict | None, inner: str) -> list[dict]:
    return [] if part is None else part[inner] if part["type"] == "Sequence" else [part]


class Tokenizer:
    """Encoder and decoder of one file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("dropout") or model.get("byte_fallback") or model.get("continuing_subword_prefix") or model.get("ignore_merges"):
            raise ValueError(f"{path}: not a plain BPE model")
        vocab, suffix = model["vocab"], model.get("end_of_word_suffix") or ""
        self.merges: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.merges.setdefault((vocab[a], vocab[b]), (rank, vocab[a + b]))
        letters = byte_characters()
        self.byte_ids = [vocab[c] for c in letters]
        self.last_ids = [vocab[c + suffix] for c in letters]
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"] if not t["normalized"]}
        if len(self.specials) < len(spec["added_tokens"]) or any(t["lstrip"] or t["rstrip"] or t["single_word"] for t in spec["added_tokens"]):
            raise ValueError(f"{path}: added tokens are not plain")
        self.special = re.compile("|".join(f"({re.escape(t)})" for t in sorted(self.specials, key=len, reverse=True)) or r"(?!)")
        self.strings = [""] * (max([*vocab.values(), *self.specials.values()]) + 1)
        for word, i in [*vocab.items(), *self.specials.items()]:
            self.strings[i] = word
        self.normalizers = _steps(spec["normalizer"], "normalizers")
        for step in self.normalizers:
            # White space is a cut between words, so to make one blank of several changes no word.
            if step["type"] not in ("NFC", "Lowercase") and (step["type"], step.get("pattern")) != ("Replace", {"Regex": r"\s+"}):
                raise ValueError(f"{path}: normalizer {step['type']}")
        split, *level = _steps(spec["pre_tokenizer"], "pretokenizers")
        if split["type"] != "Split" or split["behavior"] != "Removed" or not split["invert"] or [s["type"] for s in level] != ["ByteLevel"] or level[0]["add_prefix_space"] or level[0]["use_regex"]:
            raise ValueError(f"{path}: pre-tokenizer")
        # Classes of few ranges are far quicker, and do for most texts.
        self.cut_low, self.cut = (self._pattern(split["pattern"]["Regex"], end).findall for end in (0x378, sys.maxunicode + 1))
        self.path, self.library = path, None
        self.byte_of = {c: b for b, c in enumerate(letters)}
        if (spec["decoder"] or {"type": "ByteLevel"})["type"] != "ByteLevel":
            raise ValueError(f"{path}: decoder")
        self.bytes_of = None
        if spec["decoder"]:
            back = self.byte_of
            self.bytes_of = [bytes(back[c] for c in s) if all(c in back for c in s) else s.encode() for s in self.strings]
        self.memo: dict[str, bytes] = {}

    @staticmethod
    def _pattern(given: str, end: int) -> re.Pattern:
        for name, chars in ((r"\s", _SPACE), (r"\p{L}", _ranges("L", end)), (r"\p{N}", _ranges("N", end))):
            given = given.replace(name, chars)
        return re.compile(given)

    def merge(self, word: str) -> list[int]:
        """The ids of one word, by a queue of merge ranks over a linked list of its symbols."""
        data = word.encode("utf-8", "replace")
        n = len(data)
        if not n:
            return []
        symbol = [self.byte_ids[b] for b in data]
        symbol[-1] = self.last_ids[data[-1]]
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        # rank[i]: of the pair that begins at i, -1 where it has none; target[i]: what it becomes.
        rank, target = [-1] * n, [0] * n
        merges, queue = self.merges, []
        for i in range(n - 1):
            found = merges.get((symbol[i], symbol[i + 1]))
            if found:
                rank[i], target[i] = found
                queue.append((found[0], i))
        heapq.heapify(queue)
        while queue:
            r, i = heapq.heappop(queue)
            if rank[i] != r:
                continue  # stale: the pair at this place is another one by now, or gone
            j = after[i]
            symbol[i], symbol[j] = target[i], -1
            rank[j] = rank[i] = -1
            k = after[i] = after[j]
            if k < n:
                before[k] = i
                found = merges.get((symbol[i], symbol[k]))
                if found:
                    rank[i], target[i] = found
                    heapq.heappush(queue, (found[0], i))
            h = before[i]
            if h >= 0:
                found = merges.get((symbol[h], symbol[i]))
                if found:
                    rank[h], target[h] = found
                    heapq.heappush(queue, (found[0], h))
                else:
                    rank[h] = -1
        return [s for s in symbol if s >= 0]

    def words(self, text: str) -> list[str]:
        """The words of a text without special tokens, normalised."""
        if HIGH.search(text) and any(unicodedata.category(c) == "Cn" for c in set(text)):
            # Characters newer than Python's tables: the library's own say what they are.
            if self.library is None:
                from tokenizers import Tokenizer as Library

                self.library = Library.from_file(self.path)
            cut = self.library.pre_tokenizer.pre_tokenize_str(self.library.normalizer.normalize_str(text))
            return [bytes(map(self.byte_of.__getitem__, word)).decode() for word, _ in cut]
        for step in self.normalizers:
            if step["type"] == "NFC":
                text = unicodedata.normalize("NFC", text)
            elif step["type"] == "Lowercase":
                text = text.replace("Σ", "σ").lower()  # each character by itself: no final sigma
        return self.cut(text) if HIGH.search(text) else self.cut_low(text)

    def encode(self, texts: Iterable[str | None]) -> list[bytes]:
        """The ids of each text, as little-endian unsigned 32-bit integers."""
        parted: list[list[str | int]] = []
        for text in texts:
            parts: list[str | int] = []
            for part in self.special.split(text or ""):
                if part and part in self.specials:
                    parts.append(self.specials[part])
                elif part:
                    parts.extend(self.words(part))
            parted.append(parts)
        memo = self.memo
        met = {p for parts in parted for p in parts}
        new = [p for p in met if p not in memo]
        if len(memo) + len(new) > MEMO:  # the words of this piece stay, and so the frequent ones
            memo = self.memo = {p: memo[p] for p in met if p in memo}
        for p in new:
            memo[p] = np.array([p] if isinstance(p, int) else self.merge(p), "<u4").tobytes()
        out = [b"".join(map(memo.__getitem__, parts)) for parts in parted]
        for p in new:
            if not isinstance(p, int) and len(p) > MEMO_CHARS:
                del memo[p]
        return out

    def decode(self, ids: list[int]) -> str:
        """The vocabulary strings of the ids, joined."""
        if ids and not 0 <= min(ids) <= max(ids) < len(self.strings):
            ids = [i for i in ids if 0 <= i < len(self.strings)]
        if self.bytes_of is not None:
            return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")
        return " ".join(filter(None, map(self.strings.__getitem__, ids)))


def tokenizer(path: str) -> Tokenizer:
    """The tokenizer of a file, read once per worker."""
    if path not in _loaded:
        _loaded[path] = Tokenizer(path)
    return _loaded[path]


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, ids: the token ids of each text."""

    def run(part, col):
        ids = [np.frombuffer(b, "<u4").astype(np.int32) for b in tokenizer(path).encode(col.to_pylist())]
        return pa.RecordBatch.from_arrays([part.column(0), lists(ids, pa.int32())], ["doc_id", "ids"])

    return _keyed(docs).mapInArrow(per_piece(run), "doc_id bigint, ids array<int>")


def decode_documents(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id, text: the text that each array of ids stands for (null: empty)."""

    def run(batches):
        for batch in batches:
            texts = [tokenizer(path).decode(ids or []) for ids in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "ids").mapInArrow(run, "doc_id bigint, text string")


def digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 of the decimal ids and decoded_sha256 of the decoded text: both ways in one pass."""

    def run(part, col):
        tok = tokenizer(path)
        decimal = _decimals(len(tok.strings))
        count, ids_sha, text_sha = [], [], []
        for data in tok.encode(col.to_pylist()):
            ids = np.frombuffer(data, "<u4").tolist()
            count.append(len(ids))
            ids_sha.append(hashlib.sha256(" ".join(map(decimal.__getitem__, ids)).encode()).hexdigest())
            text_sha.append(hashlib.sha256(tok.decode(ids).encode()).hexdigest())
        cols = [part.column(0), pa.array(count, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())]
        return pa.RecordBatch.from_arrays(cols, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return _keyed(docs).mapInArrow(per_piece(run), "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")


_names: list[str] = []


def _decimals(n: int) -> list[str]:
    """The decimal form of the numbers below n."""
    if len(_names) < n:
        _names[:] = map(str, range(n))
    return _names


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.selectExpr("CAST(doc_id AS BIGINT) AS doc_id", "text")
