"""Token-id output with Re-Pair grammar compression (operator 4).

Documents are range-partitioned by their order columns, encoded, and packed into shards of about
`shard_tokens` ids. In a shard, frequent adjacent id pairs are replaced by nonterminals until no
pair is frequent; a pair never crosses the end of a document, so every document is a slice of the
shard's symbols. A shard is one row of a Parquet dataset that Spark writes and commits, with binary
fields in little-endian unsigned 32-bit integers:

    shard, part     its place: the shards of a part follow each other, parts follow each other
    base            symbols below it are ids, symbol base + k is rule k
    rules           left and right symbol of each rule (a rule names only earlier rules)
    lengths         ids that each rule expands to
    symbols         the compressed sequence
    symbol_start    n + 1 offsets into `symbols`, one for each document and the end
    token_start     n + 1 offsets into the expanded ids of the shard
    doc_ids         keys of its documents
    n_tokens        ids of the shard when expanded

so any document, or any id of it, is decoded alone from its slice and the expansion lengths.

Defined results: a null or empty text is just the end id; repeated keys are repeated documents, in
the order of their texts; rows with a null key come first; an empty table gives no shards and no
rows; other columns are neither read nor written, whatever their names.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
import zlib
from collections.abc import Callable
from unicodedata import is_normalized

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from demesne.llm.bpe import HIGH, byte_characters
from demesne.llm.common import pieces
from demesne.session import checkpoint_root

SHARD_TOKENS = 1 << 20
#: A pair is replaced while it occurs this often; fewer uses do not pay for the rule.
MIN_COUNT = 4
#: Chunks kept encoded per worker, and the length above which a chunk is not kept.
MEMO, MEMO_CHARS = 600_000, 64

SHARD_SCHEMA = (
    "part int, shard int, base int, rules binary, lengths binary, symbols binary, symbol_start binary, token_start binary, doc_ids array<bigint>, n_tokens bigint"
)
_FENCE = "\x01"
#: Punctuation from a letter or digit to the end of a chunk, told from its first sign back; a capital I with a dot ends in a combining dot in lower case.
_STOP = re.compile(r"([!-/:-@\[-`{-~](?<=[^\W_İ].)[!-/:-@\[-`{-~]*)(?=[ \n])")
_memo: dict[str, dict[str, bytes]] = {}
_tokenizers: dict = {}


def encoder(path: str) -> Callable[[list[str]], list[bytes]]:
    """A bounded list of texts -> the ids of each as bytes, by the tokenizers library with add_special_tokens=False.

    Only for tokenizers that lower case, drop white space and never join across it (such as
    word_bpe, which ends every word by a mark): the text is encoded chunk by chunk, and chunks met before in this worker are looked
    up. Punctuation that ends a word is a chunk of its own, as the tokenizer cuts there.
    """
    if path not in _tokenizers:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task is one thread
        from tokenizers import Tokenizer

        _tokenizers[path], _memo[path] = Tokenizer.from_file(path), {}
    tok, memo = _tokenizers[path], _memo[path]
    fence = tok.encode(_FENCE, add_special_tokens=False).ids
    model = tok.model
    printable = {b: c for b, c in enumerate(byte_characters())}

    def fill(new: list[str]) -> None:
        """Encode chunks; lower-case letters that all tables of characters know are one word, which goes to the model by itself."""
        for c in new:
            if c.isalpha() and c.lower() == c and not HIGH.search(c) and is_normalized("NFC", c):
                word = c if c.isascii() else c.encode().decode("latin-1").translate(printable)
                ids = [t.id for t in model.tokenize(word)]
                memo[c] = struct.pack(f"<{len(ids)}I", *ids)
        rest = [c for c in new if c not in memo and _FENCE not in c and "<|" not in c] if len(fence) == 1 else []
        if rest:  # a control character between them that none of them holds
            ids = np.array(tok.encode_batch_fast([f" {_FENCE} ".join(rest)], add_special_tokens=False)[0].ids, "<u4")
            data, at = ids.tobytes(), np.flatnonzero(ids == fence[0]).tolist()
            memo.update((c, data[4 * a + 4 : 4 * b]) for c, a, b in zip(rest, [-1, *at], [*at, len(ids)], strict=True))
        for c in new:
            if c not in memo:
                memo[c] = np.array(tok.encode(c, add_special_tokens=False).ids, "<u4").tobytes()

    def spaced(text: str) -> str:
        if "<|" not in text:  # special tokens are told by their case
            text = text.encode().lower().decode()
            text = _STOP.sub(r" \1", text)
        return text.replace("\n", " ").replace("\t", " ").replace("\r", " ")

    def encode(many: list[str]) -> list[bytes]:
        if not many:
            return []
        split = pc.split_pattern(pa.array([spaced(t) for t in many], pa.large_string()), " ")
        coded = split.values.dictionary_encode()  # every chunk of these texts is looked up once
        chunks, codes = coded.dictionary.to_numpy(zero_copy_only=False).tolist(), coded.indices.to_numpy()
        found = list(map(memo.get, chunks))
        new = [c for c, i in zip(chunks, found, strict=True) if i is None]
        if new:
            if len(memo) + len(new) > MEMO:  # the chunks of these texts stay, and so the frequent ones
                memo.clear()
                memo.update((c, i) for c, i in zip(chunks, found, strict=True) if i is not None)
            fill(new)
            found = list(map(memo.__getitem__, chunks))
            for c in new:
                if len(c) > MEMO_CHARS:
                    del memo[c]
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        ends = np.append(0, np.cumsum(sizes[codes]))
        # the id at each place is the one as far behind the start of its chunk's ids as the place is behind the chunk's first one
        shift = (np.cumsum(sizes) - sizes)[codes] - ends[:-1]
        ids = np.frombuffer(b"".join(found), "<u4")[np.repeat(shift, sizes[codes]) + np.arange(ends[-1])]
        data, at = ids.tobytes(), (4 * ends[split.offsets.to_numpy()]).tolist()
        return [data[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]

    return encode


_CLOSED = np.uint64(2**64 - 1)


def _slot(key: np.ndarray, bits: int) -> np.ndarray:
    return ((key * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - bits)).astype(np.int32)


def repair(ids: np.ndarray, ends: np.ndarray, base: int, min_count: int = MIN_COUNT) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Re-Pair over documents that end before `ends`: (rules, lengths, symbols, ends in symbols).

    A round takes the pairs that occur at least a quarter as often as the most frequent one, and
    replaces them from left to right; rounds end when no pair occurs `min_count` times, or so few
    do that a round shortens the sequence by less than a two-hundredth.
    """
    seq = ids.astype(np.uint32)
    last = np.zeros(len(seq), bool)
    last[ends[ends > 0] - 1] = True
    rules: list[np.ndarray] = []
    made, floor = 0, None
    while len(seq) > 1:
        key = seq[:-1].astype(np.uint64)
        key <<= np.uint64(32)
        key |= seq[1:]
        key[last[:-1]] = _CLOSED
        order = np.sort(key)
        cut = np.flatnonzero(np.concatenate([[True], order[1:] != order[:-1]]))
        count = np.diff(np.append(cut, len(order)))
        if order[-1] == _CLOSED:
            cut, count = cut[:-1], count[:-1]
        top = int(count.max()) if len(count) else 0
        if top < min_count:
            break
        floor = max(min_count, top // 4 if floor is None else min(floor, top) // 4)
        chosen = order[cut[count >= floor]]
        bits = max(10, int(len(chosen)).bit_length() + 2)
        place = np.full(1 << bits, -1, np.int32)
        place[_slot(chosen, bits)] = np.arange(len(chosen), dtype=np.int32)
        at = place[_slot(key, bits)]
        hit = np.flatnonzero(at >= 0)
        hit = hit[chosen[at[hit]] == key[hit]]
        run = np.maximum.accumulate(np.where(np.concatenate([[True], np.diff(hit) != 1]), np.arange(len(hit)), 0))
        hit = hit[(np.arange(len(hit)) - run) % 2 == 0]
        used = np.zeros(len(chosen), bool)
        used[at[hit]] = True
        name = np.cumsum(used, dtype=np.int64) - 1 + base + made
        pairs = chosen[used]
        rules.append(np.stack([pairs >> np.uint64(32), pairs & np.uint64(0xFFFFFFFF)], 1).astype(np.uint32))
        seq[hit] = name[at[hit]]
        made += len(pairs)
        keep = np.ones(len(seq), bool)
        keep[hit + 1] = False
        last[hit] |= last[hit + 1]
        seq, last = seq[keep], last[keep]
        if floor == min_count and len(hit) < len(seq) // 200:
            break
    table = np.concatenate(rules) if rules else np.zeros((0, 2), np.uint32)
    lengths, at = np.ones(base + len(table), np.uint32), base
    for r in rules:
        lengths[at : at + len(r)] = lengths[r].sum(1)
        at += len(r)
    # A document's end in symbols: where its expanded length is reached.
    reached = np.concatenate([[0], np.cumsum(lengths[seq], dtype=np.int64)])
    return table, lengths[base:], seq, np.searchsorted(reached, ends)


def expand(rules: np.ndarray, base: int, symbols: np.ndarray, lengths: np.ndarray | None = None) -> np.ndarray:
    """The ids that a sequence of symbols stands for; with the `lengths` of rules, what each stands for is written once and copied."""
    if lengths is not None and len(rules):
        size, nth = np.ones(len(symbols), np.int64), symbols.astype(np.int64) - base
        long_ = nth >= 0
        size[long_] = lengths[nth[long_]]
        ends = np.cumsum(size)
        total = int(lengths.sum(dtype=np.int64))
        if len(ends) and total <= ends[-1]:  # else most of what the rules stand for is in longer ones
            all_ = np.concatenate([expand(rules, base, np.arange(base, base + len(rules), dtype=np.uint32)), symbols.astype(np.uint32)])
            start = total + np.arange(len(symbols))
            start[long_] = (np.cumsum(lengths, dtype=np.int64) - lengths)[nth[long_]]
            return all_[np.repeat(start - ends + size, size) + np.arange(ends[-1])]
    seq = symbols.astype(np.uint32)
    while len(seq):
        long_ = seq >= base
        if not long_.any():
            break
        at = np.cumsum(1 + long_) - 1
        out = np.empty(at[-1] + 1, np.uint32)
        out[at] = seq
        pair = rules[seq[long_] - base]
        out[at[long_] - 1], out[at[long_]] = pair[:, 0], pair[:, 1]
        seq = out
    return seq


def token_at(shard, doc: int, position: int) -> int:
    """One id of one document of a shard row, by walking the grammar along the expansion lengths."""
    u4 = lambda name: np.frombuffer(getattr(shard, name), "<u4")
    rules, lengths, base = u4("rules").reshape(-1, 2), u4("lengths"), shard.base
    size = lambda s: int(lengths[s - base]) if s >= base else 1
    starts = u4("symbol_start")
    for s in u4("symbols")[starts[doc] : starts[doc + 1]]:
        if position < size(s):
            while s >= base:
                left, right = rules[s - base]
                s, position = (left, position) if position < size(left) else (right, position - size(left))
            return int(s)
        position -= size(s)
    raise IndexError(position)


def write_shards(docs: DataFrame, tokenizer: str, end_id: int, folder: str, order: list[str] | None = None, base: int = 1 << 16, shard_tokens: int = SHARD_TOKENS) -> None:
    """Encode `docs` (doc_id, text) in the order given (doc_id by default) and write the shards to `folder`."""
    keys = [F.col(c) for c in order or ["doc_id"]]
    spark = docs.sparkSession
    tail = np.array([end_id], "<u4").tobytes()

    def run(batches):
        encode, part, shard = encoder(tokenizer), None, 0
        held: list[tuple[int, bytes]] = []
        size = 0

        def pack():
            ends = np.cumsum([len(b) // 4 for _, b in held])
            ids = np.frombuffer(b"".join(b for _, b in held), "<u4")
            rules, lengths, symbols, cuts = repair(ids, ends, base)
            u4 = lambda a: np.ascontiguousarray(a, "<u4").tobytes()
            row = [part, shard, base, u4(rules), u4(lengths), u4(symbols), u4(np.append(0, cuts)), u4(np.append(0, ends)), [d for d, _ in held], len(ids)]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, kinds, strict=True)], names)

        names = ["part", "shard", "base", "rules", "lengths", "symbols", "symbol_start", "token_start", "doc_ids", "n_tokens"]
        kinds = [pa.int32(), pa.int32(), pa.int32(), *[pa.binary()] * 5, pa.list_(pa.int64()), pa.int64()]
        for batch in batches:
            if not batch.num_rows:
                continue
            part = batch.column(2)[0].as_py()
            for piece, col in pieces(batch):
                for doc, ids in zip(piece.column(0).to_pylist(), encode(col.to_pylist()), strict=True):
                    held.append((doc, ids + tail))
                    size += len(ids) // 4 + 1
                    if size >= shard_tokens:
                        yield pack()
                        held, size, shard = [], 0, shard + 1
        if held:
            yield pack()

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = docs.repartitionByRange(n, *keys).sortWithinPartitions(*keys, "text")
    dealt.select("doc_id", "text", F.spark_partition_id().alias("part")).mapInArrow(run, SHARD_SCHEMA).write.parquet(folder)


def read_documents(spark, folder: str) -> DataFrame:
    """Digests of the written documents, decoded from the shards: doc_id, start, n_tokens, ids_crc32."""
    shards = spark.read.parquet(folder)
    # The places of parts come from one row a part, those of shards from the rows of their part.
    count = shards.select("part", "shard", F.col("n_tokens").alias("n"))
    parts = count.groupBy("part").agg(F.sum("n").alias("n"))
    parts = parts.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    within = Window.partitionBy("part").orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    places = count.select("part", "shard", F.coalesce(F.sum("n").over(within), F.lit(0)).alias("inside"))
    places = places.join(parts, "part").select("part", "shard", (F.col("before") + F.col("inside")).alias("start"))

    def digest(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                row = {k: batch.column(j)[i].as_py() for j, k in enumerate(batch.schema.names)}
                u4 = lambda k: np.frombuffer(row[k], "<u4")  # noqa: B023, E731
                ids = expand(u4("rules").reshape(-1, 2), row["base"], u4("symbols"), u4("lengths")).astype("<u4")
                at = u4("token_start").astype(np.int64)
                sums = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(at[:-1], at[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], pa.int64()), pa.array([row["part"]] * len(sums), pa.int32()), pa.array([row["shard"]] * len(sums), pa.int32()), pa.array(at[:-1]), pa.array(np.diff(at)), pa.array(sums, pa.int64())],
                    ["doc_id", "part", "shard", "inside", "n_tokens", "ids_crc32"],
                )

    decoded = shards.mapInArrow(digest, "doc_id bigint, part int, shard int, inside bigint, n_tokens bigint, ids_crc32 bigint")
    out = decoded.join(places, ["part", "shard"])
    return out.select("doc_id", (F.col("start") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")


def encode_documents(docs: DataFrame, tokenizer: str, end_id: int, order: list[str] | None = None) -> DataFrame:
    """Write `docs` to a new folder in the shared one, read the files back, and return what they hold."""
    folder = f"{checkpoint_root(docs.sparkSession)}/tokens-{uuid.uuid4().hex}"
    write_shards(docs, tokenizer, end_id, folder, order)
    return read_documents(docs.sparkSession, folder)
