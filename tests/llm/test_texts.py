"""Token counts, language ID, decontamination and LM scores on small fixtures."""

import hashlib
import json
import math
import random
import re
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ingestkit.llm import decontam, langid, lmscore, minhash, textscan, tokencount
from ingestkit.session import work_root


def test_word_hashes_do_not_depend_on_the_stretch(monkeypatch):
    rng = random.Random(3)
    texts = [" ".join("".join(rng.choices("abcXYZé", k=rng.randint(1, 9))) for _ in range(n)) for n in (0, 1, 300, 2000)] + ["x" * 5000]
    data, offsets = textscan.as_buffer(pa.array(texts))
    whole, doc, n = textscan.word_hashes(data, offsets)
    assert n.tolist() == [len(t.split()) for t in texts]
    by_word = {}
    for w, h in zip([w.translate({i: i + 32 for i in range(65, 91)}) for t in texts for w in t.split()], whole, strict=True):
        assert by_word.setdefault(w, h) == h
    assert len(set(by_word.values())) == len(by_word)
    monkeypatch.setattr(textscan, "CHUNK_BYTES", 50)
    assert (textscan.word_hashes(data, offsets)[0] == whole).all()


# ---- token counts

@pytest.fixture(scope="module")
def tokenizer():
    tokenizers = pytest.importorskip("tokenizers")
    from ingestkit.llm.queries import tokenizer_path
    return tokenizer_path(), tokenizers.Tokenizer.from_file(tokenizer_path())


def test_counts_equal_the_library(spark, tokenizer):
    path, library = tokenizer
    rng = random.Random(4)
    signs = "abcdefghilmnrstuv'’ \n\t  .,!?1234é 　ñ漢字😀٣²Ⅷ'''srtevmld"
    texts = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    texts += ["", None, "'s", "'re x", "''re", "don't we'll I'm  you've\n\n's he'd'd", "  'll", "   ", "\n\n a", "x" * 5000,
              " " * 3000, "a<|endoftext|>b <|endoftext|>  <|endoftext|>", "<|endoftext|>", "<|endoftext", "lorem ipsum " * 20000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("n_tokens", F.lit("clash"))
    got = {r.doc_id: r for r in tokencount.count_tokens(df, path).collect()}
    again = tokencount.count_tokens(df.where("doc_id < 5").unionByName(df.where("doc_id < 5")), path).groupBy("doc_id", "n_tokens").count()
    assert sorted((r.doc_id, r.n_tokens, r["count"]) for r in again.collect()) == [(i, got[i].n_tokens, 2) for i in range(5)]
    for i, t in enumerate(texts):
        want = len(library.encode(t or "", add_special_tokens=False).ids)
        assert (got[i].n_tokens, got[i].n_bytes, got[i].over_limit) == (want, len((t or "").encode()), want > 1024), t
    assert tokencount.count_tokens(df.where("false"), path).count() == 0


def _one(compiled, text, **limits):
    data = np.frombuffer(text.encode(), np.uint8)
    machine = tokencount.Encoder(compiled["model"], **limits) if limits else None
    if machine:
        return int(machine.walk(data, np.array([0]), np.array([len(data)]))[0]), machine
    return int(tokencount.count_batch(data, np.array([0, len(data)]), compiled)[0]), None


def test_long_pieces_are_composed_from_chunks(tokenizer, monkeypatch):
    path, library = tokenizer
    with open(path) as f:
        compiled = tokencount.compile_tokenizer(f.read())
    rng = random.Random(6)
    draw = lambda letters, n: "".join(rng.choice(letters) for _ in range(n))
    texts = ["x" * 5001, "xyz" * 3000, "ab" * 2100 + "c", draw("ACGT", 9000), draw("abcdefghijklmnopqrstuvwxyzABCDEFG", 5000), "=" * 4500,
             "international" * 500, "é" * 3000, "中文" * 1500, "a" * 4096, "a" * 4097, draw("0123456789", 4300)]
    want = [len(library.encode(t, add_special_tokens=False).ids) for t in texts]
    assert [_one(compiled, t)[0] for t in texts] == want
    monkeypatch.setattr(tokencount, "LONG", 100)
    for chunk, warm in ((17, 3), (64, 64), (16, 0)):
        monkeypatch.setattr(tokencount, "CHUNK", chunk)
        monkeypatch.setattr(tokencount, "WARM", warm)
        for t, n in zip(texts, want, strict=True):
            assert _one(compiled, t[:600], max_states=10**6, max_known=10)[0] == len(library.encode(t[:600], add_special_tokens=False).ids)
        # the table of states stays bounded while a piece is walked
        got, machine = _one(compiled, texts[4], max_states=300, max_known=10)
        assert got == want[4] and len(machine.states) < 300 + 5000 // chunk * 2 + 1


def test_unsupported_added_tokens_are_refused(tokenizer):
    with open(tokenizer[0]) as f:
        spec = json.load(f)
    spec["added_tokens"].append({"content": "<x>", "lstrip": True})
    with pytest.raises(ValueError, match="<x>"):
        tokencount.compile_tokenizer(json.dumps(spec))


def test_states_can_be_thrown_away(tokenizer):
    path, library = tokenizer
    with open(path) as f:
        compiled = tokencount.compile_tokenizer(f.read())
    machine = tokencount.Encoder(compiled["model"], max_states=50, max_known=20)
    words = [w.encode() for w in "the theory of unthinkable thoughts and therefore nothing without thousands".split()]
    for _ in range(2):
        for w in words:
            data, offsets = textscan.as_buffer(pa.array([w.decode()]))
            n = machine.count(data, offsets[:1], offsets[1:])
            assert n[0] == len(library.encode(w.decode(), add_special_tokens=False).ids)


def test_scan_gives_the_states_of_a_plain_walk():
    move, mark = tokencount._splitter()
    rng = random.Random(2)
    import numpy as np
    for n in (1, 15, 16, 17, 64, 1000):
        symbols = np.array([rng.randrange(11) for _ in range(n)], np.uint8)
        rows, state = tokencount.scan_states(move, symbols, width=16)
        at, want = tokencount.START, []
        for i, s in enumerate(symbols):
            if i % 16 == 0:
                want.append(at)
            at = move[at, s]
        assert state.tolist() == want


# ---- decontamination

def _words(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))


def _brute(texts, items, window):
    out = []
    for text in texts:
        words, hit, ids = _words(text), set(), set()
        for item, body in items:
            w = _words(body)
            for j in range(max(1, len(w) - window + 1) if w else 0):
                p = w[j:j + window]
                for i in range(len(words) - len(p) + 1):
                    if words[i:i + len(p)] == p:
                        hit.update(range(i, i + len(p)))
                        if item is not None:
                            ids.add(str(item))
        out.append((len(words), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest()))
    return out


@pytest.mark.parametrize("limit", [64 << 20, 300])
def test_overlaps_equal_brute_force(spark, limit):
    rng = random.Random(5)
    vocabulary = ["a", "B", "ab", "été", "x1", "漢"]
    make = lambda n: rng.choice([" ", ", ", "\n\n", "-"]).join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, make(rng.randint(0, 7))) for i in range(12)] + [(20, None), (21, "!!"), (None, "x1 x1 x1"), (3, "ab a")]
    texts = [make(rng.randint(0, 40)) for _ in range(80)] + [None, "", "!?", "A B " * 30000]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("items", F.lit("clash"))
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontam.find_overlaps(docs, bench, window=4, max_pattern_bytes=limit)
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256) for r in decontam.overlap_digest(found).collect()}
    want = _brute(texts[:-1], items, 4)
    assert [got[i] for i in range(len(want))] == want
    for r in found.where("doc_id < 80 and n_hit > 0").collect():
        raw = texts[r.doc_id].encode()
        assert sum(len(_words(raw[s.start:s.end].decode())) for s in r.byte_spans) == r.n_hit
    assert decontam.overlap_digest(decontam.find_overlaps(docs, bench.where("false"))).where("contaminated").count() == 0
    assert decontam.find_overlaps(docs.where("false"), bench).count() == 0


# ---- language ID

SPEECH = {"en": "the and of with that this", "de": "der und nicht sich auch eine", "fr": "le et des que pour dans", "es": "el y que los para una"}


def _speech(rng, lang, n):
    return " ".join(rng.choice(SPEECH[lang].split()) + rng.choice(["", ",", "."]) for _ in range(n))


def test_languages(spark):
    work_root(spark)
    rng = random.Random(6)
    rows = [(i, _speech(rng, lang, 30), lang, "s") for i, lang in enumerate(rng.choices(list(SPEECH), k=400))]
    rows += [(1000, None, "en", None), (1001, "", None, None), (1002, "123 !?", "en", None), (None, "the and of the", None, None),
             (1004, "漢字", None, None), (1005, "der und " * 30000, None, None), (7, rows[7][1], rows[7][2], "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    model = langid.train_on(docs, sample_per_language=50)
    assert model["families"] == ["germanic", "romance"]
    out = langid.identify(docs.withColumn("score", F.lit("clash")).withColumn("held", langid.held_out("doc_id")), model).collect()
    assert len(out) == len(rows)
    got = {r.doc_id: r for r in out}
    assert all(got[i].lang_pred == "und" and got[i].score == 0 for i in (1000, 1001, 1002))
    assert got[1004].lang_pred in SPEECH and got[1005].lang_pred == "de" and got[None].lang_pred == "en"
    held = [r for r in out if r.held and r.doc_id is not None and r.doc_id < 400]
    assert sum(r.lang_pred == r.lang for r in held) >= 0.95 * len(held) and len(held) > 40
    assert all(0 <= r.score <= 1 for r in out)
    # no labels: nothing is learned; one language: everything is it
    assert {r.lang_pred for r in langid.identify(docs, langid.train(docs.where("false"))).collect()} == {"und"}
    one = langid.identify(docs, langid.train(docs.where("lang = 'fr'"))).where("doc_id < 400").collect()
    assert {r.lang_pred for r in one} == {"fr"}


def test_training_sample_is_bounded_and_has_every_language(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(langid, "remove_folder", lambda s, path: seen.append(path))
    rows = [(f"word{i} le chat", "fr") for i in range(300)] + [(f"copies of a text {i}", "en") for i in range(2) for _ in range(2000)]
    rows += [(f"der hund {i}", "de") for i in range(30) for _ in range(100)]
    model = langid.train(spark.createDataFrame(rows, "text string, lang string"), sample_per_language=20)
    assert {x for m in model["members"].values() for x in m} == {"fr", "en", "de"}
    count = {r.lang: r["count"] for r in spark.read.parquet(seen[0]).groupBy("lang").count().collect()}
    assert count == {"fr": 20, "en": 2, "de": 20}


def _peak_mb(run):
    textscan.process_cache().clear()
    tracemalloc.start()
    try:
        return run(), tracemalloc.get_traced_memory()[1] / 1e6
    finally:
        tracemalloc.stop()


def test_a_machine_is_trained_without_copies_of_its_rows():
    n, rng = 1200, np.random.default_rng(9)
    x = rng.random((n, langid.DIMENSIONS), np.float32) * (rng.random((n, langid.DIMENSIONS)) < 0.05)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    y, h = np.where(x[:, 0] + x[:, 1] > x[:, 2], 1.0, -1.0), rng.permutation(n)
    t = pa.table({"machine": [3] * n, "lang": ["a"] * n, "h": h, "y": y, "x": textscan.list_column(x.ravel(), [x.shape[1]] * n, pa.float32())})
    t = pa.concat_tables([t.slice(0, 500), t.slice(500)])
    out, peak = _peak_mb(lambda: langid._fit_group(25, 1e-4)(t))
    assert peak < 2.5 * x.nbytes / 1e6
    w = np.array(out.column("w")[0].as_py())
    wide = np.hstack([x.astype(float), np.ones((n, 1))])
    miss = np.maximum(1 - y * (wide @ w), 0)
    assert np.linalg.norm(np.r_[np.full(x.shape[1], 1e-4), 1e-9] * w - wide.T @ (y * miss) / n) < 1e-6
    other = pa.concat_tables([t.slice(700), t.slice(0, 700)])           # whatever the order of arrival
    assert langid._fit_group(25, 1e-4)(other).column("w") == out.column("w")


def test_a_worker_holds_little_at_a_time():
    rng = random.Random(10)
    texts = [" ".join(rng.choices("abcdefghijklm", k=rng.randint(0, 800))) for _ in range(3000)]
    n = len(texts)
    batch = pa.record_batch({"doc_id": range(n), "rep": range(n), "lang": ["en"] * n, "h": range(n), "rank": range(n), "text": texts})
    for run in (langid._featurize, minhash._sketches(5, 64), minhash._sets(5)):
        rows, peak = _peak_mb(lambda: sum(b.num_rows for b in run([batch])))  # noqa: B023
        assert rows == n and peak < 24


# ---- LM scores

def _scores(docs, target, mix=0.7, add=0.5):
    toks = [(i, _words(t)) for i, t in docs]
    vocabulary = {x for _, w in toks for x in w}
    count = {}
    for name, some in (("b", toks), ("t", [(i, w) for i, w in toks if i in target])):
        count[name] = (Counter(x for _, w in some for x in w), Counter(p for _, w in some for p in zip(["^", *w], w, strict=False)),
                       Counter(u for _, w in some for u in ["^", *w][:-1] if w))
    out = {}
    for i, w in toks:
        loss = []
        for name in "tb":
            one, two, before = count[name]
            p1 = lambda x: (one[x] + add) / (sum(one.values()) + add * (len(vocabulary) + 1))  # noqa: B023, E731
            loss.append(-sum(math.log(mix * two[u, x] / max(before[u], 1) + (1 - mix) * p1(x))
                             for u, x in zip(["^", *w], w, strict=False)) / max(len(w), 1))
        out[i] = (len(w), *loss) if w else (0, None, None)
    return out


def test_scores_equal_brute_force(spark):
    rng = random.Random(7)
    words = [f"w{i}" for i in range(30)]
    docs = [(i, " ".join(rng.choices(words, weights=range(30, 0, -1), k=rng.randint(0, 40)))) for i in range(60)]
    docs += [(60, None), (61, "!!"), (62, "W1, w2" * 3000), (63, "w1 w1 w2"), (63, "w1 w1 w2"), (None, "w3 w4")]
    df = spark.createDataFrame(docs, "doc_id long, text string").withColumn("n", F.lit("clash"))
    target = spark.createDataFrame([(i,) for i in range(0, 60, 3)] + [(None,), (999,), (3,)], "doc_id long")
    out = lmscore.cross_entropy_difference(df, target).collect()
    want = _scores([(i, t) for i, t in docs], set(range(0, 60, 3)))
    for r in out:
        n, t, b = want[r.doc_id]
        assert r.n_tokens == n
        if n:
            assert abs(r.loss_target - t) < 1e-9 and abs(r.loss_background - b) < 1e-9
            assert abs(r.score - (t - b)) < 1e-9
        else:
            assert r.loss_target is None and r.score is None
    assert lmscore.cross_entropy_difference(df.where("false"), target).count() == 0
    assert lmscore.cross_entropy_difference(df, target.where("false")).where("n_tokens > 0 and score is null").count() == 0


def test_rare_words_and_bigrams_count_in_a_large_corpus(spark):
    rng = random.Random(8)
    docs = [(i, " ".join(rng.choices("abcdefghij", k=rng.randint(0, 40)) + [f"rare{i}"] * (i % 7 == 0))) for i in range(60)]
    docs += [(60, None), (61, "!!"), (62, "filler text " * 600_000)]    # seen once is a share below 2^-20
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    target = spark.createDataFrame([(i,) for i in range(0, 60, 3)], "doc_id long")
    want = _scores(docs, set(range(0, 60, 3)))
    for sizes in ({}, {"block_tokens": 200, "bucket_keys": 10}):
        out = lmscore.cross_entropy_difference(df, target, **sizes).collect()
        assert len(out) == len(docs)
        for r in out:
            n, t, b = want[r.doc_id]
            assert r.n_tokens == n
            if n:
                assert abs(r.loss_target - t) < 1e-9 and abs(r.loss_background - b) < 1e-9
            else:
                assert r.loss_target is None and r.score is None
