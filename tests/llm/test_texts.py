"""Text operators against brute force, exact round trips and hostile inputs."""

import collections
import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from farol.llm import bpe, decontam, kit, langid, simhash, suffixes, toxicity

ODD = "doc_id bigint, text string, lang string, source string, n_chars bigint, score string, tid string, node string"


def odd_docs(spark):
    """Nulls in every column, empty and blank texts, ties and repeated rows, a very long text, clashing names."""
    long = " ".join(f"word{i % 977}" for i in range(30000))
    rows = [(1, None, "en", "a", None), (2, "", None, None, 0), (None, "no id here", "en", "a", 10), (3, " \t\n", "de", "b", 3), (4, "x", "en", "b", 1),
            (5, "same same", "en", "b", 9), (5, "same same", "en", "b", 9), (6, "same same", "fr", "b", 9), (7, long, "en", "a", len(long)),
            (8, "日本語 é\u0000 ½ <|endoftext|> ~<[", "ja", "c", 1), (None, None, None, None, None)]
    return spark.createDataFrame([(*r, "s", "t", "n") for r in rows], ODD)


def empty(spark):
    return spark.createDataFrame([], ODD)


@pytest.fixture(scope="module")
def merges():
    return bpe.Merges(bpe.vocabulary_text(public_tokenizers.path("byte_bpe_50k.json")))


def test_bpe_is_the_tokenizers_bpe(merges):
    exact = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rng = random.Random(1)
    texts = ["", " ", "a" * 9000, "ab" * 4000, "<|endoftext|>x<|endoftext|>", "don't WE'LL\n\n x", "é" * 80 + "日本語", "\x1c\x85\xa0 q", "😀" * 300]
    texts += ["".join(rng.choice("etaoin shrdlu,.!\n\té日😀1½'s") for _ in range(rng.randint(0, 200))) for _ in range(300)]
    texts += ["".join(rng.choice("etaoinshrdlu") for _ in range(20000))]
    encoder = bpe.Encoder(merges)
    for text in texts:
        ids = [int(i) for part in encoder.encode(text) for i in np.frombuffer(part, np.uint32)]
        assert ids == exact.encode(text, add_special_tokens=False).ids
        decoder = bpe.Decoder(merges)
        assert "".join(decoder.feed([i]) for i in ids) + decoder.end() == exact.decode(ids, skip_special_tokens=False) == text


def test_bpe_segments_and_windows_do_not_matter(merges, monkeypatch):
    text = " ".join("lorem ipsum,  dolor\n sit" for _ in range(300)) + "z" * 5000
    whole = b"".join(bpe.Encoder(merges).encode(text))
    monkeypatch.setattr(bpe, "SEGMENT", 64)
    monkeypatch.setattr(bpe, "WORDS", 8)
    assert b"".join(bpe.Encoder(merges).encode(text)) == whole


def test_every_word_goes_through_the_transducer(spark, small, merges, monkeypatch):
    texts = [r["text"] for r in spark.read.parquet(f"{small}/documents.parquet").where("text IS NOT NULL").limit(60).collect()]
    seen, own = [], bpe.transduce
    monkeypatch.setattr(bpe, "transduce", lambda chunks, m: seen.append(chunks[0]) or own(chunks, m))
    monkeypatch.setattr(bpe, "SEGMENT", 500)
    encoder = bpe.Encoder(merges)
    words = {w for t in texts for s in encoder.segments(t) for w in encoder.split(s)}
    parts = [list(encoder.encode(t)) for t in texts]
    assert set(seen) == {w.encode() for w in words} and len(seen) == len(words)
    # Tokens come out before the text has been read to its end.
    assert max(map(len, parts)) > 1 and all(len(p) > 1 for p, t in zip(parts, texts) if len(t) > 2000)


def test_bpe_rows(spark):
    vocabulary = bpe.vocabulary_text(public_tokenizers.path("byte_bpe_50k.json"))
    rows = bpe.encode_decode(odd_docs(spark), vocabulary, outputs=True).collect()
    assert len(rows) == 11 and all(hashlib.sha256(r["ids"]).hexdigest() == r["ids_sha256"] and len(r["ids"]) == 4 * r["n_tokens"] for r in rows)
    assert sorted(r["decoded"] for r in rows) == sorted((r["text"] or "") for r in odd_docs(spark).collect())
    assert bpe.encode_decode(empty(spark), vocabulary).count() == 0


def brute_repeats(texts, window):
    seen = collections.Counter(t[i:i + window] for t in texts for i in range(len(t) - window + 1))
    out = []
    for t in texts:
        gone = np.zeros(len(t), bool)
        for i in range(len(t) - window + 1):
            if seen[t[i:i + window]] > 1:
                gone[i:i + window] = True
        out.append((int(gone.sum()), len(suffixes._runs(gone)), hashlib.sha256(np.frombuffer(t, np.uint8)[~gone].tobytes()).hexdigest()))
    return out


def test_suffix_array_sorts():
    rng = np.random.default_rng(2)
    for n in [*range(12), 40, 77, 200]:
        for most in (1, 2, 250):
            s = rng.integers(1, most + 1, n)
            assert suffixes.suffix_array(s).tolist() == sorted(range(n), key=lambda i: s[i:].tolist())


@pytest.mark.parametrize("window,crowd", [(200, None), (50, None), (50, 1)])
def test_suffix_dedup_is_brute_force(spark, window, crowd):
    rng = random.Random(window)
    line = "".join(rng.choice("abcdef é") for _ in range(300))
    texts = ["".join(rng.choice("abcdef é") for _ in range(rng.randint(0, 700))) for _ in range(30)]
    texts = [t[:k] + line[j:j + 260] + t[k:] if i % 2 else t for i, (t, k, j) in enumerate((t, rng.randint(0, len(t)), rng.randint(0, 40)) for t in texts)]
    texts += [texts[1], texts[1], None, "", "ab" * 400, line + line, "z" * 199]
    docs = spark.createDataFrame([(i if i % 7 else None, t, "x") for i, t in enumerate(texts)], "doc_id bigint, text string, n_removed string")
    got = sorted((r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in suffixes.dedup(docs, window, crowd).collect())
    raw = [(t or "").encode() for t in texts]
    assert got == sorted((len(t), *b) for t, b in zip(raw, brute_repeats(raw, window)))


def test_suffix_stage_keeps_rows_and_columns(spark):
    docs = odd_docs(spark)
    out = suffixes.without_repeats(docs, 200)
    assert out.schema == docs.schema and out.count() == docs.count()
    assert out.where("doc_id = 1").first()["text"] is None
    assert suffixes.without_repeats(empty(spark)).count() == 0
    assert suffixes.dedup(empty(spark)).count() == 0


def fingerprint(text, words=3):
    w = (text or "").encode().lower().split()
    runs = [b" ".join(w[i:i + words]) for i in range(len(w) - words + 1)] or ([b" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(r, seed=42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def classes(ids, fps, radius):
    root = list(range(len(ids)))
    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(ids)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                root[find(i)] = find(j)
    low = collections.defaultdict(list)
    for i in range(len(ids)):
        low[find(i)].append(ids[i])
    return [min((x for x in low[find(i)] if x is not None), default=None) for i in range(len(ids))]


@pytest.mark.parametrize("bucket", [None, 2])
def test_simhash_is_brute_force(spark, bucket):
    rng = random.Random(5)
    base = [" ".join(rng.choice(["Ab", "cd", "ef", "gh", "ij", "é"]) + str(rng.randint(0, 40)) for _ in range(rng.randint(1, 200))) for _ in range(12)]
    texts = []
    for t in base:
        for k in range(12):
            w = t.split()
            for _ in range(k // 4):
                w[rng.randrange(len(w))] = "new"
            texts.append(" ".join(w))
    texts += [None, "", " \x0b ", "a b"]
    docs = spark.createDataFrame([(1000 - i, t, "c") for i, t in enumerate(texts)] + [(None, texts[0], "c")], "doc_id bigint, text string, fp string")
    rows = docs.collect()
    fps = [fingerprint(r["text"]) for r in rows]
    expected = sorted((str(r["doc_id"]), f"{f:016x}", c) for r, f, c in zip(rows, fps, classes([r["doc_id"] for r in rows], fps, 2)))
    got = simhash.near_duplicates(docs, bucket=bucket).collect()
    assert sorted((str(r["doc_id"]), r["fingerprint"], r["component_id"]) for r in got) == expected


def test_masks_cover_every_pair_in_the_radius():
    for radius in (1, 2, 5):
        masks = [m & (1 << 64) - 1 for m in simhash.masks(radius)]
        rng = random.Random(radius)
        for _ in range(3000):
            off = sum(1 << i for i in rng.sample(range(64), radius))
            assert any(m & off == 0 for m in masks)


@pytest.mark.parametrize("bucket", [None, 4])
def test_one_of_each_group_stays(spark, bucket):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    rows = []
    for g in range(15):
        text = [word() for _ in range(400)]
        for k in range(8):
            w = list(text)
            if k % 2:
                w[rng.randrange(400)] = "changed"
            rows.append((len(rows), " ".join(w), f"g{g}"))
    docs = spark.createDataFrame([*rows, rows[0], rows[3], (None, rows[0][1], "g0")], "doc_id bigint, text string, root string")
    roots = classes([r[0] for r in rows], [fingerprint(r[1]) for r in rows], 2)
    kept = simhash.one_of_each(docs, bucket=bucket).collect()
    assert sorted(r["doc_id"] for r in kept) == sorted(set(roots))
    assert simhash.one_of_each(odd_docs(spark)).schema == odd_docs(spark).schema
    odd = [r for r in odd_docs(spark).collect()]
    groups = {fingerprint(r["text"]) for r in odd}
    assert simhash.one_of_each(odd_docs(spark)).count() == len(set(classes(list(range(len(groups))), sorted(groups), 2)))
    assert simhash.one_of_each(empty(spark)).count() == 0 and simhash.near_duplicates(empty(spark)).count() == 0


def test_components(spark):
    links = spark.createDataFrame([(i + 1, i) for i in range(40)] + [(100, 101), (7, 7), (101, 100)], "a bigint, b bigint")
    got = {r["node"]: r["root"] for r in kit.components(links).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}
    assert kit.components(links.where("a < 0")).count() == 0


def test_language_of_held_out_rows(spark, medium):
    docs = spark.read.parquet(f"{medium}/documents.parquet")
    held = kit.crc_mod("doc_id", 4) == 2
    out = langid.predict(docs, langid.fit(docs.where(~held)), [held.alias("held_out"), F.col("lang")]).where("held_out AND lang IS NOT NULL")
    assert out.where("lang = lang_pred").count() >= 0.95 * out.count()


def test_slices_of_a_long_text_count_every_gram_once(monkeypatch):
    text = "".join(random.Random(3).choice("abc é") for _ in range(200))
    whole = np.sort(langid._buckets(text))
    monkeypatch.setattr(langid, "SLICE", 50)
    assert np.array_equal(np.sort(np.concatenate([langid._buckets(p) for p in langid._slices(text)])), whole)


def test_language_of_odd_rows(spark):
    model = langid.fit(odd_docs(spark))
    got = langid.predict(odd_docs(spark), model).collect()
    assert len(got) == 11 and all(r["lang_pred"] == "und" for r in got if r["doc_id"] in (1, 2, 3)) and all(0 <= r["score"] <= 1 for r in got)
    assert {r["lang_pred"] for r in langid.predict(odd_docs(spark), langid.fit(empty(spark))).collect()} == {"und"}
    assert langid.predict(empty(spark), model).count() == 0


def test_toxicity_learns_from_positives_and_unlabelled():
    rng = np.random.default_rng(4)
    words = [f"w{i}" for i in range(500)]
    def text(bad):
        w = list(rng.choice(words, 60))
        return " ".join(w + (list(rng.choice(["scum", "vile", "rot"], 2)) if bad else []))
    truth = rng.random(1500) < 0.2
    texts = [text(b) for b in truth]
    known = [toxicity.grams(t) for t, b in zip(texts[:600], truth) if b]
    model = toxicity.fit_sets(known, [toxicity.grams(t) for t in texts[:1000]], 0.2)
    score = model.scorer()
    guess = np.array([score(t) >= 0.7 for t in texts[1000:]])
    assert (guess == truth[1000:]).mean() > 0.97
    assert 0 <= score(None) < 0.7 and score("") == score(None)


def test_toxicity_learns_from_a_bounded_sample_in_one_order(spark):
    texts = spark.createDataFrame([(i % 3, f"word{i} word{i % 7}") for i in range(200)] * 2, "doc_id bigint, text string")
    first, again = (toxicity.sets_of(t, 50) for t in (texts.repartition(3), texts.repartition(6, "text")))
    assert len(first) == 50 and all((a == b).all() for a, b in zip(first, again))
    assert len(toxicity.sets_of(texts, 1000)) == 400 and toxicity.sets_of(texts.where("doc_id > 5"), 10) == []


def test_toxicity_of_odd_rows(spark):
    labels = spark.createDataFrame([(4, 1, 0), (5, 1, 1), (5, 0, 0), (None, 1, 1), (99, 1, None)], "doc_id bigint, quality int, toxic int")
    model = toxicity.fit(odd_docs(spark), labels)
    assert toxicity.score(odd_docs(spark), model).where("score BETWEEN 0 AND 1").count() == 11
    none = toxicity.fit(odd_docs(spark), labels.where("toxic = 0"))
    assert none is None and toxicity.accepted(odd_docs(spark), none).count() == 11
    assert toxicity.accepted(odd_docs(spark), none).schema == odd_docs(spark).schema
    assert toxicity.score(empty(spark), model).count() == 0


def test_longest_common_subsequence():
    rng = random.Random(3)
    for _ in range(200):
        a, b = ([rng.choice("abcd") for _ in range(rng.randint(0, 12))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        assert decontam.common_subsequence(a, b) == table[-1][-1]


def test_contaminated_documents_are_found(spark, medium):
    docs, items = (spark.read.parquet(f"{medium}/{t}.parquet") for t in ("documents", "benchmark"))
    texts, wanted = docs.collect(), items.collect()
    truth = {(d["doc_id"], i["item_id"]) for d in texts for i in wanted if d["text"] and i["text"] in d["text"]}
    got = decontam.contaminated(docs, items).collect()
    found = {(r["doc_id"], r["item_id"]) for r in got}
    assert truth <= found and all(r["share"] >= decontam.REWORDED for r in got) and len(found - truth) <= 3
    assert decontam.clean(docs, items).count() == len(texts) - len({d for d, _ in found})


def test_contamination_of_odd_rows(spark):
    items = spark.createDataFrame([(1, None), (2, ""), (3, "?!"), (4, "word5 word6 word7 word8 word9 word10 word11 word12"), (4, "word5 word6 word7 word8 word9 word10 word11 word12")],
                                  "item_id bigint, text string")
    found = decontam.contaminated(odd_docs(spark), items).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found} == {(7, 4)}
    assert decontam.clean(odd_docs(spark), items).schema == odd_docs(spark).schema
    assert decontam.contaminated(odd_docs(spark), items.where("item_id < 0")).count() == 0
    assert decontam.contaminated(empty(spark), items).count() == 0


def test_frequencies_and_factors_equal_direct_ones(spark):
    texts = zipf_texts(np.random.default_rng(4), 90, 60, 400) + ["", None, "v11 v11 v11"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(7)
    total, df = decontam.frequencies(docs)
    direct = np.zeros(1 << decontam.BITS, np.int64)
    for t in texts:
        direct[list({zlib.crc32(w) >> (32 - decontam.BITS) for w in decontam.words(t)})] += 1
    assert total == len(texts) and (df == direct).all()
    assert decontam.frequencies(empty(spark))[0] == 0 and not decontam.frequencies(empty(spark))[1].any()

    idf = np.log((1.0 + total) / (1.0 + df)) + 0.05
    parts = decontam.passages(docs.withColumnRenamed("doc_id", "item_id")).repartition(5)
    ids = [r["buckets"] for r in parts.collect()]
    dense = np.zeros((len(ids), 1 << decontam.BITS))
    for row, one in zip(dense, ids):
        at, x = decontam._sparse(one, idf)
        row[at] = x
    at, vectors = decontam.latent(parts, len(ids), idf)
    dense = dense[:, at]
    assert list(at) == sorted(set(sum(ids, []))) and vectors.shape[1] <= min(decontam.RANK, len(ids))
    # With as many dimensions as passages the projection loses nothing: it is orthonormal and gives every passage back.
    assert np.abs(vectors.T @ vectors - np.eye(vectors.shape[1])).max() < 1e-4
    assert np.abs(dense @ vectors @ vectors.T - dense).max() < 1e-3


def test_items_of_unknown_words_and_of_equal_shares(spark):
    item = "one two three four five six seven eight nine ten"
    items = spark.createDataFrame([(1, "never seen words of no document at all here"), (2, item), (3, item)], "item_id bigint, text string")
    docs = spark.createDataFrame([(1, f"before it {item} after it"), (2, "other words that say other things"), (1, f"before it {item} after it")], "doc_id bigint, text string")
    assert sorted((r["doc_id"], r["item_id"], r["share"], r["kind"]) for r in decontam.contaminated(docs, items).collect()) == sorted(
        2 * [(1, 2, 1.0, "copy"), (1, 3, 1.0, "copy")])


def zipf_texts(rng, n, words, vocabulary=20000):
    odds = 1 / np.arange(10, vocabulary + 10)
    return [" ".join(f"v{w}" for w in rng.choice(vocabulary, words, p=odds / odds.sum())) for _ in range(n)]


def test_copies_of_many_passages_are_found(spark):
    rng = np.random.default_rng(11)
    passages, texts = zipf_texts(rng, 2000, 40), zipf_texts(rng, 400, 150)
    owner = {i: int(rng.integers(2000)) for i in range(0, 400, 2)}
    for i, p in owner.items():
        at = int(rng.integers(150))
        texts[i] = " ".join([*texts[i].split()[:at], passages[p], *texts[i].split()[at:]])
    items = spark.createDataFrame(list(enumerate(passages)), "item_id bigint, text string")
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    assert {(r["doc_id"], r["item_id"]) for r in decontam.contaminated(docs, items).collect()} == set(owner.items())
    # The latent vectors by themselves, without the runs of words.
    search = decontam.Search(*next(decontam.searches(docs, items))[:-1], [])
    found = sum(any(hit[0] == p for hit in search.hits(texts[i])) for i, p in owner.items())
    assert found >= 0.9 * len(owner)


def test_items_in_a_third_of_the_documents_are_found(spark, medium):
    texts = [r["text"] or "" for r in spark.read.parquet(f"{medium}/documents.parquet").orderBy("doc_id").limit(450).collect()]
    items = spark.read.parquet(f"{medium}/benchmark.parquet").collect()
    short = min(items, key=lambda r: len(decontam.words(r["text"])))
    middle = min(items, key=lambda r: abs(len(decontam.words(r["text"])) - 29))
    rng = random.Random(12)
    for item in (short, middle):
        planted = list(texts)
        for i in range(0, len(texts), 3):
            ws = texts[i].split(" ")
            at = rng.randint(0, len(ws))
            planted[i] = " ".join([*ws[:at], item["text"], *ws[at:]])
        docs = spark.createDataFrame(list(enumerate(planted)), "doc_id bigint, text string")
        found = decontam.contaminated(docs, spark.createDataFrame([tuple(r) for r in items], "item_id bigint, text string"))
        assert {r["doc_id"] for r in found.where(f"item_id = {item['item_id']}").collect()} >= set(range(0, len(texts), 3))
        # The latent vectors by themselves, without the runs of words.
        search = decontam.Search(*next(decontam.searches(docs, spark.createDataFrame([tuple(r) for r in items], "item_id bigint, text string")))[:-1], [])
        assert sum(any(hit[0] == item["item_id"] for hit in search.hits(planted[i])) for i in range(0, len(texts), 3)) == len(range(0, len(texts), 3))
