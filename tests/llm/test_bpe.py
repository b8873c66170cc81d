"""Byte-pair encoding against the library, and a brute-force merge."""

import hashlib
import json
import random

import numpy as np
import pytest
from tokenizers import Tokenizer as Library

from demesne.llm import bpe
from demesne.llm.queries import QUERIES, tokenizer_path

ALPHABET = "aAbBéÉİßΣσς'’.,!?<|>-_0129 \n\t½²Ⅷ̣̇­​　漢字😀ñẞȺ\U0001e5d0\x1c\x85"


@pytest.fixture(scope="module")
def library():
    return Library.from_file(tokenizer_path())


def ids(data):
    return np.frombuffer(data, "<u4").tolist()


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_random_texts_as_the_library(library):
    rng = random.Random(3)
    own = bpe.tokenizer(tokenizer_path())
    texts = ["".join(rng.choice(ALPHABET) for _ in range(rng.randrange(40))) for _ in range(4000)]
    texts += [t + "<|endoftext|>" + t + "<|STARTOFTEXT|> we'LL" for t in texts[:300]] + ["TÜRKİYE'DEKİ, ve BİLGİ. evet", "a" * 5000, ""]
    for text, found in zip(texts, own.encode(texts), strict=True):
        wanted = library.encode(text, add_special_tokens=False).ids
        assert ids(found) == wanted, text
        assert own.decode(wanted) == library.decode(wanted, skip_special_tokens=False)


def test_queue_merges_as_by_scanning(library):
    own = bpe.tokenizer(tokenizer_path())
    rng = random.Random(5)
    for _ in range(300):
        word = "".join(rng.choice("thenrigasé") for _ in range(rng.randrange(1, 30)))
        data = word.encode()
        symbols = [own.byte_ids[b] for b in data[:-1]] + [own.last_ids[data[-1]]]
        while True:  # the lowest rank of all pairs, the first of equals
            ranked = [(own.merges[p][0], i) for i, p in enumerate(zip(symbols, symbols[1:], strict=False)) if p in own.merges]
            if not ranked:
                break
            i = min(ranked)[1]
            symbols[i : i + 2] = [own.merges[symbols[i], symbols[i + 1]][1]]
        assert own.merge(word) == symbols


def test_few_words_are_kept(monkeypatch, library):
    monkeypatch.setattr(bpe, "MEMO", 20)
    own = bpe.Tokenizer(tokenizer_path())
    texts = [f"word{k} and the {'long' * 30}{k}" for k in range(50)]
    for text in texts:
        assert ids(own.encode([text])[0]) == library.encode(text, add_special_tokens=False).ids
        assert len(own.memo) <= 20


def test_digests_of_odd_rows(odd, library):
    found = {(r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe.digests(odd, tokenizer_path()).collect()}
    rows = odd.select("doc_id", "text").collect()
    wanted = set()
    for key, text in rows:
        i = library.encode(text or "", add_special_tokens=False).ids
        wanted.add((key, len(i), sha(" ".join(map(str, i))), sha(library.decode(i, skip_special_tokens=False))))
    assert found == wanted
    assert bpe.digests(odd, tokenizer_path()).count() == len(rows)


def test_encode_then_decode(odd, none, library):
    encoded = bpe.encode_documents(odd, tokenizer_path()).cache()
    rows = sorted((r.doc_id or -1, r.text) for r in bpe.decode_documents(encoded, tokenizer_path()).collect())
    assert rows == sorted((k or -1, library.decode(library.encode(t or "", add_special_tokens=False).ids, skip_special_tokens=False)) for k, t in odd.select("doc_id", "text").collect())
    assert bpe.encode_documents(none, tokenizer_path()).count() == 0 and bpe.digests(none, tokenizer_path()).count() == 0


def test_query(spark, library):
    folder = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = QUERIES["op11_bpe_codec"](spark, folder).collect()
    assert len(rows) == len(texts)
    for r in rows:
        i = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(i), sha(" ".join(map(str, i))), sha(library.decode(i, skip_special_tokens=False)))


@pytest.mark.parametrize("change", [{"model": {"dropout": 0.1}}, {"decoder": {"type": "WordPiece"}}, {"normalizer": {"type": "NFKC"}}, {"pre_tokenizer": {"type": "Whitespace"}}])
def test_other_files_are_refused(tmp_path, change):
    spec = json.load(open(tokenizer_path()))
    for key, value in change.items():
        spec[key] = {**spec[key], **value} if key == "model" else value
    path = tmp_path / "t.json"
    path.write_text(json.dumps(spec))
    with pytest.raises(ValueError):
        bpe.Tokenizer(str(path))


def test_token_output_encodes_random_texts_as_the_library(library):
    """The chunk-wise encoder of the token-id output, on single texts and mixed scripts."""
    from demesne.llm import token_output

    rng = random.Random(13)
    parts = [*ALPHABET, " , ", ". ", ",\n", "İ. ", "BİLGİ, ", "ʹ", "豈", "ᄀ", "é"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randrange(30))) for _ in range(6000)] + ["TÜRKİYE'DEKİ, ve BİLGİ. evet"]
    encode = token_output.encoder(tokenizer_path())
    for k in range(0, len(texts), 500):
        for text, found in zip(texts[k : k + 500], encode(texts[k : k + 500]), strict=True):
            assert ids(found) == library.encode(text, add_special_tokens=False).ids, text
