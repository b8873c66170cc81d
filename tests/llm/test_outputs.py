"""Mixing (3), token ids (4), decontamination (5), licenses (6) and the pipeline."""

import re
import zlib
from collections import defaultdict
from fractions import Fraction

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
import corpus_pipeline
from demesne.llm import decontaminate, jaccard, language, licenses, mixing, queries, token_output

SMALL = "/root/testdata/sf0.001"


# --- mixing ---


def test_order_of_a_frame_keeps_every_source_within_a_block(spark):
    for counts in ([5, 1, 1, 1, 1, 1], [3, 3, 2], [97, 2, 1], [1], [10, 0, 7, 30], [1, 1, 1, 1]):
        (row,) = spark.createDataFrame([(counts,)], "c array<bigint>").select(mixing.edf_order(F.col("c")).alias("o")).collect()
        total, done = sum(counts), [0] * len(counts)
        assert len(row.o) == total
        for t, s in enumerate(row.o, 1):
            done[s] += 1
            for c, d in zip(counts, done):
                assert abs(d - Fraction(t * c, total)) < 1


def test_mixture_is_whole_and_follows_the_weights(spark):
    rows = [(i, "x" * 100, s) for s, n in (("a", 4000), ("b", 900), ("c", 300)) for i in range(n)]
    docs = spark.createDataFrame([(k, t, s) for k, (_, t, s) in enumerate(rows)], "doc_id long, text string, source string")
    weights = spark.createDataFrame([("a", 0.5), ("b", 0.3), ("c", 0.2)], "source string, weight double")
    out = sorted(mixing.schedule(docs, weights, 1000, 10, ["doc_id", "source"]).collect(), key=lambda r: (r.slot, r.place, r.doc_id))
    assert sorted(r.doc_id for r in out) == list(range(len(rows)))
    of_slot = {r.slot: r.source for r in out}
    assert sorted(of_slot) == list(range(520))
    until = 150  # c has 30 blocks, 2 in each ten
    done = defaultdict(int)
    for t in range(until):
        done[of_slot[t]] += 1
        for s, w in (("a", 0.5), ("b", 0.3), ("c", 0.2)):
            assert abs(done[s] - w * (t + 1)) < 1
    for t in range(until, 240):  # then 5 and 3 of eight
        done[of_slot[t]] += 1
        assert abs(done["a"] - 75 - (t + 1 - until) * 5 / 8) < 1


def test_mixture_keeps_within_a_block_of_the_weights_given(spark):
    """Weights that no frame divides: a third among many sources, a thousandth, and sources that run out."""
    third = [("big", 150, 1 / 3), *[(f"s{i:03}", 1, 2 / 3 / 300) for i in range(300)]]
    for sources in (third, [("a", 2997, 0.999), ("b", 3, 0.001)], [("a", 37, 0.37), ("b", 90, 0.41), ("c", 11, 0.153), ("d", 2, 0.067)]):
        counts = spark.createDataFrame([x[:2] for x in sources], "_s string, _blocks long")
        weights = spark.createDataFrame([(s, w) for s, _, w in sources], "source string, weight double")
        of_slot = {}
        for r in mixing.slots(counts, weights).collect():
            of_slot |= dict.fromkeys(r["_slots"], r["_s"])
        assert sorted(of_slot) == list(range(sum(b for _, b, _ in sources)))
        flow, done = {s: 0.0 for s, _, _ in sources}, defaultdict(int)
        for t in range(len(of_slot)):
            done[of_slot[t]] += 1
            left = 1.0  # of this slot, to be filled by the sources that still have blocks
            while left > 1e-9:
                live = [(s, b, w) for s, b, w in sources if flow[s] < b - 1e-9]
                total = sum(w for _, _, w in live)
                if not live:
                    break
                part = min(left, *((b - flow[s]) * total / w for s, b, w in live))
                for s, _, w in live:
                    flow[s] += part * w / total
                left -= part
            assert all(abs(done[s] - flow[s]) < 1 + 1e-6 for s in flow)


def test_mixing_on_odd_rows(odd, none):
    out = mixing.mix_in_order(odd, block_chars=500)
    assert out.columns == odd.columns
    assert sorted(map(str, out.collect())) == sorted(map(str, odd.collect()))
    placed = mixing.schedule(odd, block_chars=500)
    assert placed.columns == [c for c in odd.columns if c not in ("slot", "place")] + ["slot", "place"]
    assert mixing.schedule(none).count() == 0 and mixing.mix_in_order(none).columns == none.columns


# --- token ids ---


def plain_ids(rows):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(queries.tokenizer_path())
    out, at = [], 0
    for key, text in rows:
        ids = tok.encode(text or "", add_special_tokens=False).ids + [queries.END_ID]
        out.append((key, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    return out


def test_ids_read_back_are_those_of_the_library(odd, none):
    rows = sorted(((r.doc_id, r.text) for r in odd.collect()), key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, (r[1] or "").encode()))
    got = token_output.encode_documents(odd, queries.tokenizer_path(), queries.END_ID).collect()
    assert sorted((tuple(r) for r in got), key=lambda r: r[1]) == plain_ids(rows)
    assert token_output.encode_documents(none, queries.tokenizer_path(), queries.END_ID).count() == 0


def test_chunks_encode_like_whole_texts():
    from tokenizers import Tokenizer

    path = queries.tokenizer_path()
    tok, encode = Tokenizer.from_file(path), token_output.encoder(path)
    texts = ["", " ", "a.b. c, d.. e!,", "Ünï é́ É́ İstanbul ΟΔΟΣ ΣΑΣ", "don't I'LL 4.0. x_. _,", "<|endoftext|> a<|startoftext|>b <|ENDOFTEXT|>", "tab\tnl\r\nnbsp x y\x1cz\x01 \x01\x01", "½ ²³ Ⅷ ٣ 你好。 한국 ǅ ŉ ẞ ﬁ", "́x ́", "x" * 300 + "."]
    texts += [" ".join(texts)]
    for text, ids in zip(texts, encode(texts), strict=True):
        assert np.frombuffer(ids, "<u4").tolist() == tok.encode(text, add_special_tokens=False).ids, text


def test_grammar_round_trip_and_random_access(spark, tmp_path):
    rng = np.random.default_rng(3)
    for n in (0, 1, 2, 50, 5000):
        ids = np.concatenate([rng.zipf(1.4, n) % 50, np.tile(rng.integers(0, 50, 7), n // 5)]).astype(np.uint32)
        ends = np.sort(rng.integers(0, len(ids) + 1, 6))
        ends[-1] = len(ids)
        rules, lengths, symbols, cuts = token_output.repair(ids.copy(), ends, 1 << 16)
        assert np.array_equal(token_output.expand(rules, 1 << 16, symbols), ids)
        starts = np.append(0, cuts)
        for a, b, x, y in zip(starts, cuts, np.append(0, ends), ends):
            assert np.array_equal(token_output.expand(rules, 1 << 16, symbols[a:b]), ids[x:y])
        for k in range(len(rules)):
            assert lengths[k] == len(token_output.expand(rules, 1 << 16, np.array([k + (1 << 16)])))
    docs = spark.createDataFrame([(i, "ab cd ab cd ab cd " * i) for i in range(1, 9)], "doc_id long, text string")
    token_output.write_shards(docs, queries.tokenizer_path(), 1, str(tmp_path / "s"), shard_tokens=40)
    for shard in spark.read.parquet(str(tmp_path / "s")).collect():
        rules = np.frombuffer(shard.rules, "<u4").reshape(-1, 2)
        whole = token_output.expand(rules, shard.base, np.frombuffer(shard.symbols, "<u4"))
        at = np.frombuffer(shard.token_start, "<u4")
        for d in range(len(shard.doc_ids)):
            assert [token_output.token_at(shard, d, k) for k in range(at[d + 1] - at[d])] == whole[at[d] : at[d + 1]].tolist()
    assert spark.read.parquet(str(tmp_path / "s")).count() > 2


# --- decontamination ---


def normal(text):
    return " " + " ".join(re.findall(r"[a-z0-9\x80-\U0010ffff]+", "".join(c.lower() if c < "\x80" else c for c in text or ""))) + " "


def test_leaks_are_the_items_that_stand_in_texts(spark):
    docs, items = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "benchmark"))
    got = {(r.doc_id, r.item_id) for r in decontaminate.leaks(docs, items).collect()}
    wanted = {r.item_id: normal(r.text) for r in items.collect()}
    want = {(r.doc_id, i) for r in docs.collect() for i, t in wanted.items() if t in normal(r.text)}
    assert got == want and want


def test_block_max_retrieval_is_that_of_all_scores():
    rng = np.random.default_rng(5)
    words = [f"w{k}" for k in range(60)]
    text = lambda n: " ".join(rng.choice(words, n))
    index = decontaminate.Index([(i, text(rng.integers(1, 12))) for i in range(150)])
    passages = [text(rng.integers(0, 60)) for _ in range(40)]
    hashes, first = decontaminate.word_hashes(pa.array(passages, pa.large_string()))
    got = {(i, a, item): s for i, a, _, item, s in index.retrieve(hashes, first, 0.5)}
    want = {}
    table = np.zeros((len(index.words), len(index.ids)))
    table[np.repeat(np.arange(len(index.words)), np.diff(index.at)), index.item] = index.weight
    for i in range(len(passages)):
        for a in range(int(first[i]), max(int(first[i + 1]), int(first[i]) + 1), index.half):
            own = np.unique(hashes[a : min(a + 2 * index.half, int(first[i + 1]))])
            score = table[np.isin(index.words, own)].sum(0)
            want |= {(i, a, int(k)): score[k] for k in np.flatnonzero(score >= 0.5)}
    assert got.keys() == want.keys() and all(np.isclose(got[k], want[k]) for k in want)


def test_edited_items_leak_and_others_do_not(spark):
    item = "What is the boiling point of water at the level of the sea in the old scale of degrees? It is two hundred and twelve degrees on that scale."
    near = item.replace("old scale", "Old, scale").upper()
    docs = [(1, "x " * 200 + near + " y" * 300), (2, item.split("?")[0]), (3, item.split("?")[1]), (4, "water degrees scale sea " * 30), (5, None), (6, "")]
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    items = spark.createDataFrame([(7, item), (8, ""), (9, None), (10, "?"), (None, item)], "item_id long, text string")
    assert sorted(((r.doc_id, r.item_id) for r in decontaminate.leaks(docs, items).collect()), key=str) == [(1, 7), (1, None)]
    assert sorted(r.doc_id for r in decontaminate.without_leaks(docs, items).collect()) == [2, 3, 4, 5, 6]


def test_a_leak_without_a_key_takes_no_clean_row_along(spark):
    item = "What is the boiling point of water at the level of the sea in the old scale of degrees? It is two hundred and twelve degrees on that scale."
    docs = spark.createDataFrame([(None, item), (None, "clean " * 30), (None, None), (1, item), (2, "clean")], "doc_id long, text string")
    kept = decontaminate.without_leaks(docs, spark.createDataFrame([(7, item)], "item_id long, text string"))
    assert sorted(map(str, kept.collect())) == sorted(map(str, docs.where("text is null or text <> '" + item + "'").collect()))


def test_decontamination_on_odd_rows(odd, none, spark):
    items = spark.createDataFrame([(1, next(r.text for r in odd.collect() if r.doc_id == 13))], "item_id long, text string")
    kept = decontaminate.without_leaks(odd, items)
    leaked = items.first().text
    assert kept.columns == odd.columns and None in {r.doc_id for r in kept.collect()}
    assert leaked not in {r.text for r in kept.collect()} and 13 in {r.doc_id for r in kept.collect()}  # the other text of its key stays
    assert decontaminate.leaks(none, items).count() == 0 and decontaminate.leaks(odd, items.limit(0)).count() == 0


# --- licenses ---


def test_license_notices(spark):
    notice = licenses.TEMPLATES["MIT"][2]
    shorter = " ".join(notice.split()[4:])
    docs = [(1, "x y z " * 50 + "\nReleased under the MIT License.\n" + "q r " * 40), (2, "released under mit"), (3, "a " * 333 + notice + " b"), (4, "a " * 57 + shorter), (5, "a " + " ".join(notice.split()[:20])), (6, None), (7, "")]
    got = licenses.license_notices(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.license, r.template) for r in got) == [(1, "MIT", 3), (3, "MIT", 5), (4, "MIT", 5)]
    assert {r.doc_id: r.first_word for r in got} == {1: 150, 3: 333, 4: 57}


def test_licenses_are_those_of_all_windows(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = {(r.doc_id, r.license) for r in licenses.license_notices(docs).collect()}
    want = {(r.doc_id, name) for r in docs.collect() for name, texts in licenses.TEMPLATES.items() for t in texts if normal(t) in normal(r.text)}
    assert got == want and want


def test_licenses_on_odd_rows(odd, none):
    assert licenses.license_notices(odd).count() == 0 and licenses.license_notices(none).count() == 0
    assert licenses.license_notices(odd, {}).count() == 0


# --- registered queries and the pipeline ---


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ("documents", "labels", "benchmark", "pages", "conversations", "embeddings"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_registered_query(spark, con, name):
    assert name in entry_point.queries()
    df = queries.QUERIES[name](spark, SMALL)
    rows = sorted(map(str, (tuple(r[c] for c in sorted(df.columns)) for r in df.collect())))
    if name in queries.ORACLES:
        want = con.sql(queries.ORACLES[name])
        order = sorted(range(len(want.columns)), key=lambda i: want.columns[i])
        assert sorted(want.columns) == sorted(df.columns)
        assert rows == sorted(str(tuple(r[i] for i in order)) for r in want.fetchall())
    elif name not in ("op5_benchmark_decontamination", "op6_license_scan"):
        n = spark.read.parquet(f"{SMALL}/documents.parquet").count()
        assert len(rows) == n + (spark.read.parquet(f"{SMALL}/pages.parquet").count() if name.startswith("op9") else 0)


def test_pipeline_against_its_steps_one_by_one(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    items = spark.read.parquet(f"{SMALL}/benchmark.parquet")
    found = {r.key for r in language.identify(language.evidence_from_documents(docs)).where("accepted").collect()}
    rows = sorted((r.doc_id, r.text) for r in docs.collect() if r.doc_id in found)
    least = {r.doc_id: r.component_id for r in jaccard.link_documents(spark.createDataFrame(rows, "doc_id long, text string"), 5, 80).collect()}
    rows = [r for r in rows if least[r[0]] == r[0]]
    wanted = [normal(r.text) for r in items.collect()]
    rows = [r for r in rows if not any(t in normal(r[1]) for t in wanted)]
    source = {r.doc_id: r.source for r in docs.collect()}
    mixed = mixing.schedule(spark.createDataFrame([(d, t, source[d]) for d, t in rows], "doc_id long, text string, source string"))
    order = [r.doc_id for r in sorted(mixed.collect(), key=lambda r: (r.slot, r.place, r.doc_id))]
    texts = dict(rows)
    got = sorted((tuple(r) for r in corpus_pipeline.run(spark, SMALL).collect()), key=lambda r: r[1])
    assert got == plain_ids([(d, texts[d]) for d in order])
    assert corpus_pipeline.ORACLE_SQL is None and len(corpus_pipeline.STAGES) == 5


def test_stages_return_the_columns_of_documents(spark, odd):
    docs = odd.select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SMALL)
        assert out.columns == docs.columns and dict(out.dtypes) == dict(docs.dtypes)


def test_a_chunk_of_several_texts_is_looked_up_once(monkeypatch):
    path = queries.tokenizer_path()
    asked = []

    class Memo(dict):
        def get(self, key, default=None):
            asked.append(key)
            return super().get(key, default)

    token_output.encoder(path)
    monkeypatch.setitem(token_output._memo, path, Memo())
    from tokenizers import Tokenizer

    texts = ["aa bb. bb aa", "", "bb\ncc!! \u00e9\u00e9  aa", "x" * 100, "<|endoftext|> Aa", "aa " * 500, " . "]
    encode, tok = token_output.encoder(path), Tokenizer.from_file(path)
    for many in (texts, texts[::-1], []):
        asked.clear()
        assert [np.frombuffer(b, "<u4").tolist() for b in encode(many)] == [tok.encode(t, add_special_tokens=False).ids for t in many]
        assert len(asked) == len(set(asked)) < 20
