"""Every training-data operator against brute force on small tables, and on the tables that tend to break things."""

from __future__ import annotations

import hashlib
import random
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.oracle import same
from tickloom.llm import decontamination, language_id, near_dedup, nearest, queries, shingles, source_mixing, suffix_dedup, token_counts, tool_calls, toxicity, url_filter
from tickloom.llm.common import materialize
from tickloom.llm.components import components

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, label string, node string, key string, row string, size long"
RNG = random.Random(7)
WORDS = ["".join(RNG.choice("abcdefghijklmnop") for _ in range(RNG.randint(2, 8))) for _ in range(400)]


def prose(n, seed):
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) for _ in range(n))


def table(spark, rows):
    """rows (doc_id, text); the other columns hold nulls or names that operators use inside."""
    return spark.createDataFrame([(i, t, "en" if i is not None and i % 2 else None, None if i is None else f"s{i % 3}", None, "x", "x", "x", "x", 1) for i, t in rows], SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty, repeated and long texts, ties, null keys, clashing columns."""
    long = prose(30_000, 1)
    rows = [(1, None), (2, ""), (3, "  \n"), (4, prose(200, 2)), (4, prose(200, 2)), (5, prose(200, 2)), (None, prose(90, 3)), (None, None), (6, long), (7, long + "!"), (8, "12 34"), (9, "日本語 テキスト ß"), (10, "a"), (11, "a")]
    return table(spark, rows)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def test_token_counts_equal_the_library(spark, odd, none):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(queries.BYTE_VOCAB)
    got = token_counts.count_tokens(odd, queries.BYTE_VOCAB)
    assert none.count() == token_counts.count_tokens(none, queries.BYTE_VOCAB).count() == 0
    want = Counter((r.doc_id, len((r.text or "").encode()), len(library.encode(r.text or "", add_special_tokens=False).ids)) for r in odd.collect())
    assert Counter((r.doc_id, r.n_bytes, r.n_tokens) for r in got.collect()) == want
    merger = token_counts.RankMerger(queries.BYTE_VOCAB)
    texts = ["it's 'S ''s\n's don't<|endoftext|>re <|endoftext|>", "aaaa" * 3000, " \t\n x  ", "１２ ½ x", "!!!'''ll", "　 x", "naïve café 🙂🙂"]
    assert merger.count(texts) == [len(library.encode(t, add_special_tokens=False).ids) for t in texts]


def test_forward_sums_all_segmentations():
    pieces = ["▁", "a", "b", "ab", "▁a", "▁ab", "ba"]
    p = np.array([[0.1], [0.2], [0.15], [0.25], [0.1], [0.05], [0.15]])
    scorer = language_id.Scorer.__new__(language_id.Scorer)
    scorer.model, scorer.lattice = language_id.Model(["x"], "", p), language_id.Lattice(pieces)

    def total(w):
        return 1.0 if not w else sum(p[i, 0] * total(w[len(s) :]) for i, s in enumerate(pieces) if w.startswith(s))

    words = ["a", "ab", "aba", "abab"]
    assert np.allclose(np.exp(scorer.forward(words))[:, 0], [total("▁" + w) for w in words])
    words = ["ab", "abc", "ab" * 8, "cba", "ab" * 17]  # c stands in no piece
    assert np.allclose(scorer.forward(words), [scorer.forward_long(w) for w in words])
    # a long run of letters is one word: no split, no underflow
    step = scorer.forward_long("ab" * 201)[0] - scorer.forward_long("ab" * 200)[0]
    long = scorer.forward_long("ab" * 4000)[0]
    assert np.isfinite(long) and abs(long - scorer.forward_long("ab" * 200)[0] - 3800 * step) < 1e-6 * abs(long)


def test_language_id_equals_brute_force():
    """predict against sums over every segmentation, written out."""
    pieces = ["▁", "a", "b", "c", "ab", "▁a", "bc", "▁abc", "ca"]
    r = np.random.default_rng(9)
    p = r.random((len(pieces), 3))
    p /= p.sum(0)
    scorer = language_id.Scorer.__new__(language_id.Scorer)
    scorer.model, scorer.lattice, scorer.index, scorer.table = language_id.Model(["x", "y", "z"], "", p), language_id.Lattice(pieces), {}, np.zeros((0, 3))

    def total(w):
        if not w:
            return np.ones(3)
        ways = [language_id.FLOOR * total(w[1:])] + [p[i] * total(w[len(s) :]) for i, s in enumerate(pieces) if w.startswith(s)]
        return np.sum(ways, axis=0)

    q = random.Random(4)
    texts = [" ".join("".join(q.choice("abcé") for _ in range(q.randint(1, 7))) for _ in range(q.randint(1, 5))) for _ in range(40)]
    names, scores, means = scorer.predict(texts)
    for t, name, score, mean in zip(texts, names, scores, means):
        logs = sum(np.log(total("▁" + w)) for w in t.split())
        odds = np.exp(logs - logs.max())
        assert name == "xyz"[int(logs.argmax())] and abs(score - odds.max() / odds.sum()) < 1e-9 and abs(mean - logs.max() / len(t.replace(" ", ""))) < 1e-9


def test_numerals_are_no_letters():
    assert language_id.words_of("½ ² ① Ⅷ 3 _") == [] and language_id.words_of("a½b Ñandú x²") == ["a", "b", "ñandú", "x"]


def test_language_id(spark, odd, none):
    rows = [(i, " ".join(random.Random(i).choices(["the", "and", "tion"] if i % 2 else ["der", "und", "ung"], k=30)), "en" if i % 2 else "de") for i in range(80)]
    docs = spark.createDataFrame([*rows, (100, None, "en"), (101, "12 !", "de"), (None, "the and", "en")], "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in language_id.identify(docs, queries.PIECE_VOCAB).collect()}
    assert all(got[i].lang_pred == want for i, _, want in rows) and any(r.held_out for r in got.values())
    assert (got[100].lang_pred, got[100].score, got[101].lang_pred) == ("und", 0.0, "und") and not got[None].held_out
    foreign = docs.union(spark.createDataFrame([(200, "אבגד הוזח טיכל", None), (201, "½ ②", None)], docs.schema))
    assert {r.doc_id for r in foreign.collect()} - {r.doc_id for r in language_id.keep_identified(foreign, queries.PIECE_VOCAB).collect()} == {100, 101, 200, 201}
    assert language_id.keep_identified(docs, queries.PIECE_VOCAB).columns == docs.columns
    assert {r.doc_id for r in docs.collect()} - {r.doc_id for r in language_id.keep_identified(docs, queries.PIECE_VOCAB).collect()} == {100, 101}
    assert language_id.identify(odd, queries.PIECE_VOCAB).count() == odd.count()
    assert language_id.identify(none, queries.PIECE_VOCAB).count() == 0


def test_language_id_keeps_rare_languages(spark):
    rows = [(i, f"the and tion {i}", "en") for i in range(3000)] + [(5000 + i, f"der und ung {i}", "de") for i in range(8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language_id.fit(docs, queries.PIECE_VOCAB, "text", "lang", "doc_id", 60)
    assert model.languages == ["de", "en"]
    assert language_id.Scorer(model).predict(["der und", "the and"])[0] == ["de", "en"]
    assert language_id.most_of_each([8, 3000, 40], 108) == 60 and language_id.most_of_each([8, 40], 48) == float("inf")


def test_mixing_meets_targets_and_the_sql(spark, odd, none):
    rows = [(i, prose(random.Random(i).randint(0, 60), i), None if i % 5 == 0 else f"s{i % 4}") for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = source_mixing.mix_report(docs).toPandas()
    con = duckdb.connect()
    con.register("documents", docs.toPandas())
    want = con.execute(queries.OP7_SQL).df()
    order = ["doc_id"]
    assert got.sort_values(order)["taken"].tolist() == want.sort_values(order)["taken"].tolist()
    assert (got["taken"] <= 2 * got["size"]).all() and got["target"].groupby(got["target"]).size().shape[0] <= 5
    for _, part in got.groupby("source_size"):
        assert abs(part["taken"].sum() - part["target"].iloc[0]) <= part["size"].max()
    mixed = source_mixing.mixed(docs)
    assert mixed.columns == docs.columns and mixed.count() == int((got["taken"] / got["size"].replace(0, 1)).sum() + sum(1 for _ in ()) + mixed.where(source_mixing.words(F.col("text")) == 0).count())
    assert source_mixing.mix_report(odd).count() == odd.count() and source_mixing.mix_report(none).count() == 0
    weighed = source_mixing.mix_report(docs.withColumn("w", F.col("doc_id") % 2), odds="w")
    assert weighed.count() == 400


def brute_repeats(texts, length):
    seen = Counter(b[i : i + length] for b in texts for i in range(len(b) - length + 1))
    out = []
    for b in texts:
        mark = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                mark[i : i + length] = b"\1" * length
        spans = sum(1 for j, m in enumerate(mark) if m and (j == 0 or not mark[j - 1]))
        out.append((len(b), sum(mark), spans, hashlib.sha256(bytes(x for x, m in zip(b, mark) if not m)).hexdigest()))
    return out


def test_interval_expansion_equals_brute_force():
    r = random.Random(3)
    for _ in range(60):
        length, letters = r.choice([30, 45, 60]), r.choice([b"ab", b"abcdefgh"])
        base = bytes(r.choice(letters) for _ in range(300))
        strings = []
        for _ in range(r.randint(1, 6)):
            x = bytearray(base[r.randint(0, 90) : r.randint(120, 300)])
            for _ in range(r.randint(0, 3)):
                x[r.randrange(len(x))] = r.choice(letters)
            strings.append(bytes(x))
        weights = np.array([r.choice([1, 1, 2]) for _ in strings])
        seen = Counter()
        for s, w in zip(strings, weights):
            for i in range(len(s) - length + 1):
                seen[s[i : i + length]] += int(w)
        want = [[i for i in range(len(s) - length + 1) if seen[s[i : i + length]] > 1] for s in strings]
        found = [[] for _ in strings]
        for i, a, b in zip(*(x.tolist() for x in suffix_dedup.repeated(strings, weights, length))):
            found[i] += range(a, b + 1)
        assert found == want


@pytest.mark.parametrize("most", [500, 1])
def test_suffix_dedup_equals_brute_force(spark, none, most, monkeypatch):
    passage, short = prose(100, 50), prose(60, 51)[:330]
    rows = [(i, prose(30 + i, i) + " " + passage + " " + prose(20, 1000 + i)) for i in range(12)] + [(20, passage), (21, passage), (22, None), (23, ""), (24, "é" * 300), (25, "xé" * 50 + "é" * 260), (26, "ab" * 500), (None, prose(150, 3)), (27, prose(150, 3))]
    rows += [(30 + i, prose(20 + i, 60 + i) + " " + short + " " + prose(10, 70 + i)) for i in range(3)]
    docs = table(spark, rows)
    monkeypatch.setattr(suffix_dedup, "KEY_REGIONS", most)  # 1: every shared key goes through the split
    got = suffix_dedup.dedup_report(docs).collect()
    want = brute_repeats([(t or "").encode() for _, t in rows], suffix_dedup.LENGTH)
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == Counter((i, *w) for (i, _), w in zip(rows, want))
    assert {r.doc_id for r in got if r.shares_passage} == {*range(12), 20, 21, 24, 25, None, 27, 30, 31, 32}
    if most > 1:
        assert suffix_dedup.dedup_report(none).count() == 0
        cut = suffix_dedup.without_repeats(docs)
        assert cut.columns == docs.columns and cut.count() == docs.count()
        kept = {r.doc_id: r.text for r in cut.collect()}
        assert kept[20] == "" and kept[22] is None and passage not in kept[3] and short in kept[30]
        kept = {r.doc_id: r.text for r in suffix_dedup.without_repeats(docs, length=250, least_words=51).collect()}
        assert short not in kept[30] and kept[26] == "ab" * 500 and passage not in kept[3]


def test_suffix_dedup_reads_over_segments(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "SEGMENT", 1 << 10)
    passage = prose(80, 52)
    rows = [(i, prose(300 + 37 * i, 80 + i) + " " + passage + " " + prose(250, 90 + i) + passage[:450]) for i in range(4)]
    got = Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.dedup_report(table(spark, rows)).collect())
    assert got == Counter((i, *w) for (i, _), w in zip(rows, brute_repeats([t.encode() for _, t in rows], suffix_dedup.LENGTH)))


def test_runs_of_a_hot_passage_are_joined(spark, monkeypatch):
    """A passage at the edges of which very many texts differ: one run per text and piece, not one per position."""
    monkeypatch.setattr(suffix_dedup, "KEY_REGIONS", 20)
    passage = prose(90, 53)
    rows = [(i, prose(12, 2000 + i) + " " + passage + " " + prose(12, 3000 + i)) for i in range(120)]
    docs = table(spark, rows)
    cut = materialize(suffix_dedup.cut_texts(docs, "text", "doc_id", suffix_dedup.LENGTH, False))
    hits = suffix_dedup.repeats(docs, cut, "text", "doc_id", suffix_dedup.LENGTH).collect()
    assert len(hits) == 120 and sum(len(h["low"]) for r in hits for h in r.hits) <= 8 * 120


def test_dart_signatures_estimate_weighted_similarity():
    r = np.random.default_rng(1)
    x = r.integers(1, 1 << 62, 300, dtype=np.uint64)
    a, b = r.random(300) * 3, r.random(300) * 3
    s = near_dedup.signatures(np.concatenate([x, x, x[:1]]), np.concatenate([a, b, [1.0]]), np.array([300, 300, 1, 0]), 4096)
    assert abs((s[0] == s[1]).mean() - np.minimum(a, b).sum() / np.maximum(a, b).sum()) < 0.04
    assert np.isfinite(s[2]).all() and np.isinf(s[3]).all()


def test_near_duplicates_equal_brute_force(spark, odd, none):
    rows, r = [], random.Random(5)
    for g in range(12):
        base = prose(120, 500 + g).split()
        for k in range(g + 1):
            w = list(base)
            for _ in range(r.randint(0, 3)):
                w[r.randrange(len(w))] = r.choice(WORDS) + "x"
            rows.append((len(rows), " ".join(w)))
    got = {x.doc_id: x.class_id for x in near_dedup.near_duplicates(table(spark, rows)).collect()}
    sets = shingles.Shingler().sets([t for _, t in rows])
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if shingles.jaccard(sets[i], sets[j]) >= 0.8:
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    assert got == {i: find(i) for i in range(len(rows))}
    kept = near_dedup.one_per_class(odd)
    assert kept.columns == odd.columns and Counter(x.doc_id for x in kept.collect()) == Counter([1, 2, 3, None, None, 4, 6, 8, 9, 10])
    assert near_dedup.near_duplicates(odd).count() == odd.count() and near_dedup.near_duplicates(none).count() == 0
    assert near_dedup.one_per_class(none).count() == 0


def chain():
    """Four texts, each linked to the next only; the first and the last have the smallest and the largest node."""
    for seed in range(100):
        words = prose(134, 800 + seed).split()
        texts = [" ".join(words[10 * i : 10 * i + 104]) for i in range(4)]
        nodes = [hashlib.md5(t.encode()).digest() for t in texts]
        if (min(nodes), max(nodes)) == (nodes[0], nodes[3]):
            return texts
    raise AssertionError


def one_band(links):
    """links, as if all texts had met in a single band."""
    return lambda buckets, sets: links(buckets.select("node").distinct().withColumn("band", F.lit(0).cast("long")), sets)


def test_near_duplicates_link_components_of_two_leaders(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "_links", one_band(near_dedup._links))
    got = near_dedup.near_duplicates(table(spark, list(enumerate(chain())))).collect()
    assert {r.doc_id: r.class_id for r in got} == dict.fromkeys(range(4), 0)


def test_near_duplicates_link_repeated_rows(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "_links", one_band(near_dedup._links))
    rows = list(enumerate(chain()))
    got = near_dedup.near_duplicates(table(spark, rows + [rows[1]] * 2)).collect()
    assert Counter(r.class_id for r in got) == {0: 6}
    null = table(spark, [(None, t) for _, t in [*rows, rows[1]]])
    assert sum(r.kept for r in near_dedup.near_duplicates(null).collect()) == 1


def test_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40) if i != 20] + [(50, 60)], "a long, b long")
    assert {r.node: r.label for r in components(edges).collect()} == {i: 0 if i <= 20 else 21 for i in range(41)} | {50: 50, 60: 50}


def test_block_max_wand_equals_exhaustive_search():
    index = decontamination.Index([prose(random.Random(i).randint(5, 40), i) for i in range(120)])
    r = random.Random(2)
    for _ in range(60):
        query, least = r.sample(range(len(index.vocabulary)), 40), r.choice([0.05, 0.1, 0.2, 0.3])
        scores = Counter()
        for t in query:
            for item, x in zip(*index.postings[t]):
                scores[item] += x
        assert {i for i, _ in index.search(query, least)} == {i for i, s in scores.items() if s >= least}


def brute_leaks(texts, items):
    """BM25 of every passage and item, normalised by the item's own score; then question and answer overlap."""
    words = [decontamination.terms(t) for t in items]
    mean, step = np.mean([len(w) for w in words]), max(32, max(map(len, words)))
    df = Counter(w for ws in words for w in set(ws))

    def score(terms, item):
        total = 0.0
        for w in set(terms):
            c = item.count(w)
            idf = np.log(1 + (len(words) - df[w] + 0.5) / (df[w] + 0.5))
            total += idf * c * (decontamination.K1 + 1) / (c + decontamination.K1 * (1 - decontamination.B + decontamination.B * len(item) / mean)) if c else 0.0
        return total

    out = {}
    for d, t in enumerate(texts):
        ws = decontamination.terms(t)
        blocks = [ws[i : i + step] for i in range(0, len(ws), step)]
        passages = [a + b for a, b in zip(blocks, blocks[1:])] or blocks
        for i, item in enumerate(words):
            best = max((score(p, item) / score(item, item) for p in passages), default=0.0)
            overlaps = [np.mean([" ".join(ws).find(" ".join(s)) >= 0 for s in decontamination.shingles(part)]) for part in decontamination.question_and_answer(items[i])]
            if best >= decontamination.SCORE and min(overlaps) >= decontamination.OVERLAP:
                out[d, i] = (round(best, 6), *(round(float(x), 6) for x in overlaps))
    return out


def test_leaks_equal_brute_force(spark):
    r = random.Random(8)
    items = [prose(r.randint(8, 30), 600 + i).capitalize() + ". " + prose(r.randint(3, 9), 650 + i).capitalize() + "." for i in range(25)]
    texts = []
    for i in range(60):
        words = items[i % 25].split()
        for _ in range(i // 30):  # up to one word changed
            words[r.randrange(len(words))] = r.choice(WORDS)
        texts.append(prose(r.randint(0, 200), i) + " " + " ".join(words[: r.choice([len(words), len(words), len(words) - 4])]) + " " + prose(r.randint(0, 90), 70 + i))
    found = decontamination.find_leaks(table(spark, list(enumerate(texts))), spark.createDataFrame(list(enumerate(items)), "item_id long, text string"))
    got = {(x.doc_id, x.item_id): (round(x.score, 6), round(x.question_overlap, 6), round(x.answer_overlap, 6)) for x in found.collect()}
    want = brute_leaks(texts, items)
    assert set(got) == set(want) and 15 < len(got) < 60
    assert all(np.allclose(got[k], want[k], atol=1e-5) for k in want)


def test_leaks_are_found_and_clean_texts_left(spark, odd, none):
    items = [(i, prose(25, 9000 + i).capitalize() + ". " + prose(8, 9500 + i).capitalize() + ".") for i in range(30)] + [(98, None), (99, "")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    rows = [(i, prose(300, i) + (" " + items[i][1].upper() + " " if i < 10 else "") + prose(100, 700 + i)) for i in range(40)]
    rows += [(100, items[3][1].split(". ")[0] + " " + prose(60, 4)), (101, None), (102, "")]
    found = {(r.doc_id, r.item_id) for r in decontamination.find_leaks(table(spark, rows), bench).collect()}
    assert found == {(i, i) for i in range(10)}
    kept = decontamination.without_leaks(table(spark, rows), bench)
    assert {r.doc_id for r in kept.collect()} == {i for i, _ in rows} - set(range(10)) and len(kept.columns) == len(SCHEMA.split(", "))
    assert decontamination.find_leaks(odd, bench.limit(0)).count() == 0 == decontamination.find_leaks(none, bench).count()


def test_leaks_do_not_depend_on_shards(spark, monkeypatch):
    items = [(i, prose(30 + 3 * i, 9000 + i).capitalize() + ". " + prose(8, 9500 + i).capitalize() + ".") for i in range(20)]
    bench = spark.createDataFrame([*items, (98, None), (99, " ")], "item_id long, text string")
    docs = table(spark, [(i, prose(300, i) + " zz " + items[i][1].split(" ", 3)[3] + " " + prose(100, 700 + i)) for i in range(20)])
    find = lambda: {(r.doc_id, r.item_id): (round(r.score, 9), r.question_overlap, r.answer_overlap) for r in decontamination.find_leaks(docs, bench).collect()}
    want = find()
    monkeypatch.setattr(decontamination, "SHARD_BYTES", 1500)
    assert len(decontamination.shards(bench, "item_id", "text")) > 2
    assert len(want) == 20 and find() == want
    assert decontamination.without_leaks(docs, bench).count() == 0


def test_gradients_and_learning(spark, odd, none):
    bad = ["zorgon", "blirt"]
    texts = [prose(60, i) + (f" {bad[i % 2]} " if i % 4 == 0 else " ") + prose(40, 300 + i) for i in range(240)]
    labels = [int(i % 4 == 0) for i in range(240)]
    net = toxicity.train(texts, labels)
    scores = np.array(toxicity.Scorer(net).scores([prose(50, 9000) + " zorgon", prose(90, 9001), "", None]))
    assert scores[0] > 0.5 > scores[1] and scores[2] == scores[3] == 0
    words = sorted(set(toxicity.terms(texts[0])))
    ids = net.ids(words)
    win = toxicity.windows_of(len(words))[:3]
    args = (win, win >= 0, ids, np.ones(len(win)), np.ones(len(win)))
    grads = net.step(*args)

    def loss():
        x = net.inputs(ids)
        both = np.concatenate([net.run(d, (x @ net.p["x" + d] + net.p["c" + d])[np.where(win >= 0, win, 0)], win >= 0) for d in "fb"], axis=2)
        return -np.log(toxicity.sigmoid(net.pool(both, win >= 0)[2])).mean()

    for name in net.p:
        flat = net.p[name].reshape(-1)
        at = int(np.abs(grads[name]).argmax())
        old, h = flat[at], 1e-5
        flat[at] = old + h
        up = loss()
        flat[at] = old - h
        down = loss()
        flat[at] = old
        assert abs((up - down) / (2 * h) - grads[name].reshape(-1)[at]) < 1e-5 + 1e-3 * abs(grads[name].reshape(-1)[at]), name
    marks = spark.createDataFrame([(4, 1), (9, 0), (8, None), (None, 1)], "doc_id long, toxic int")
    assert toxicity.rate_toxicity(odd, marks).count() == odd.count()
    assert toxicity.rate_toxicity(none, marks.limit(0)).count() == 0


@pytest.mark.parametrize("most", [128, 4])
def test_nearest_recall_and_ties(spark, most, monkeypatch):
    monkeypatch.setattr(nearest, "MOST_PARTS", most)
    monkeypatch.setattr(nearest, "ROWS_PER_PART", 40 if most == 4 else 800)  # 4: the parts of the first cut are cut again
    r = np.random.default_rng(4)
    centres = r.normal(size=(8, 16))
    rows = [(i, (centres[i % 8] + 0.4 * r.normal(size=16)).astype(np.float32).tolist()) for i in range(1200)]
    rows += [(2000 + i, rows[50][1]) for i in range(20)] + [(3000, None), (3001, [0.0] * 16), (3002, [float("nan")] * 16), (3003, [None] * 16), (None, rows[0][1])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 as id", "'x' as part", "2 as one", "3 as v")
    got: dict[int, list] = {}
    for x in nearest.nearest(frame).orderBy("query_id", "rank").collect():
        got.setdefault(x.query_id, []).append((x.vec_id, x.score))
    ids = np.array([i for i, v in rows if i is not None and i < 3000])
    m = np.array([v for i, v in rows if i is not None and i < 3000], np.float64)
    hits = 0
    for q in ids[ids % 50 == 0]:
        v = m[ids == q][0]
        s = (m * v).sum(1) / np.sqrt((m * m).sum(1) * (v * v).sum())
        s[ids == q] = -9
        want = ids[np.lexsort((ids, -s))[:5]]
        hits += len({i for i, _ in got[q]} & set(want.tolist()))
    assert set(got) == set(ids[ids % 50 == 0].tolist()) and hits >= 0.9 * 5 * len(got)
    assert [i for i, _ in got[50]] == [2000, 2001, 2002, 2003, 2004] and abs(got[50][0][1] - 1) < 1e-12
    assert nearest.nearest(frame.limit(0)).count() == 0
    assert nearest.nearest(frame.where("vec_id in (0, 1, 2)")).count() == 2


def test_nearest_hashes_are_those_of_spark(spark):
    r = np.random.default_rng(6)
    x = r.normal(size=(40, 5))
    x[3, 2], x[4, 1], x[5] = -0.0, 1e300, 5e-324
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "i int, v array<double>")
    want = frame.selectExpr("i", "xxhash64(v) as one", "xxhash64('again', v) as two").orderBy("i").collect()
    one, two = nearest.spread(x)
    assert one.tolist() == [w.one for w in want] and two.tolist() == [w.two for w in want]


def test_nearest_in_a_cell():
    """Exact nearest among the visited parts, however many at a time, ties and near ties to the smaller first id."""
    r = np.random.default_rng(9)
    c = r.normal(size=(300, 16)) * 10.0 ** r.integers(-20, 20, (300, 1))
    c[100:140] = c[7] * 2.0 ** np.arange(-20, 20)[:, None]  # equal cosines
    c[140:160] = c[7] * (1 + 1e-12 * r.normal(size=(20, 16)))  # single precision cannot tell them
    first, part, q = r.permutation(300), r.integers(0, 6, 300), np.concatenate([r.normal(size=(30, 16)), c[7:8]])
    pairs = [(i, p) for i in range(31) for p in range(7) if r.random() < 0.6 or (i < 30 and p == i % 6) or i == 30]
    asking, asked = (np.array(x) for x in zip(*pairs))
    best, score = nearest.best_in_cell(c, first, part, q, asking, asked, 6)
    for i in range(31):
        rows = np.flatnonzero(np.isin(part, [p for j, p in pairs if j == i]))
        s = (c[rows] * q[i]).sum(1) / (np.sqrt((c[rows] * c[rows]).sum(1)) * np.sqrt((q[i] * q[i]).sum()))
        order = np.lexsort((first[rows], -s))[:6]
        assert best[i].tolist() == rows[order].tolist() and score[i].tolist() == s[order].tolist()
    assert (nearest.best_in_cell(c[:2], first[:2], part[:2], q, asking, asked, 6)[0] >= 0).sum(1).max() <= 2


def test_nearest_deals_a_query_once_to_a_cell(spark, monkeypatch):
    """Small parts share cells, so that a query goes to a few cells and not to each of its parts; copies go as ids."""
    monkeypatch.setattr(nearest, "ROWS_PER_PART", 40)
    dealt = []
    monkeypatch.setattr(nearest.Cells, "plan", classmethod(lambda cls, sizes, visits, queries, room, plan=nearest.Cells.plan.__func__: dealt.append((plan(cls, sizes, visits, queries, room), visits, queries)) or dealt[-1][0]))
    r = np.random.default_rng(4)
    rows = [(i, r.normal(size=8).tolist()) for i in range(1200)]
    rows += [(5000 + i, rows[50][1]) for i in range(3000)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = nearest.nearest(frame).collect()
    assert len(got) == 5 * (24 + 60)
    copies = {x.query_id: [] for x in got if x.query_id in (50, 5050, 7950)}
    for x in sorted(got, key=lambda x: x["rank"]):
        if x.query_id in copies:
            copies[x.query_id].append(x.vec_id)
    assert copies == {50: [5000, 5001, 5002, 5003, 5004], 5050: [50, 5000, 5001, 5002, 5003], 7950: [50, 5000, 5001, 5002, 5003]}
    ((cells, visits, queries),) = dealt
    assert queries == 24 and visits.sum() > 5 * queries and cells.first.max() == 0 and cells.turns.tolist() == [1]
    big = nearest.Cells.plan(np.array([10, 4500, 30, 0, 1990]), np.array([5, 20_000, 5, 0, 5]), 20_000, 2000)
    assert big.first.tolist() == [0, 1, 4, 4, 5] and big.blocks.tolist() == [1, 3, 1, 1, 1] and big.turns.tolist() == [1, 3, 3, 3, 1, 1]


def test_url_rules_and_templates(spark, none):
    urls = ["https://a.org/x", "http://example.org/es/1", "http://WWW.Example.ORG/es/2?q", "http://example.org/en/19", "http://example.org/en/2", "http://b.com/fr/1", "http://b.com/de/1", "http://notorg/", "no scheme", None, "", "http://host?x", "http://comb.com/es/1", "ftp://x.org"]
    want = ["allow org/", "block example.org/es/", "block example.org/es/", "block example.org/en/1", "allow org/", "allow com/fr/", "block com/de/", None, None, None, None, None, None, None]
    rows = list(enumerate(urls)) + [(100 + i, f"http://blog.net/tag/{'spam' if i % 2 else 'news'}-{i}") for i in range(60)] + [(0, urls[0])]
    rows.append((999, "http://long.net/" + "x" * 50_000 + "/" + "y/" * 30))
    pages = spark.createDataFrame(rows, "page_id long, url string").selectExpr("*", "'x' as host", "'x' as path", "1 as bad", "'x' as shape", "'x' as template", "2 as k", "3 as n")
    labelled = spark.createDataFrame([(100 + i, i % 2) for i in range(40)] + [(100, 0), (7, None)], "page_id long, bad int").selectExpr("*", "'x' as host", "1 as k")
    got = {r.page_id: r for r in url_filter.judge(pages, labelled).collect()}
    for i, w in enumerate(want):
        assert (f"{got[i].verdict} {got[i].rule}" if got[i].rule else None) == w
    assert (got[2].host, got[2].path, got[9].host, got[11].host, got[11].path) == ("www.example.org", "/es/2", "", "host", "")
    assert {got[100 + i].verdict for i in range(60) if i % 2} == {"block"} and {got[100 + i].verdict for i in range(60) if not i % 2} == {"allow"}
    assert url_filter.judge(pages, labelled).count() == len(rows) and url_filter.judge(pages.limit(0), labelled.limit(0)).count() == 0


def test_url_templates_of_deep_paths(spark):
    deep = "/".join("abcdefghijk")
    urls = [f"http://deep.net/a/b/c/d/e/{'spam' if i % 2 else 'news'}/{i}" for i in range(60)] + [f"http://deep.net/{deep}/x", f"http://deep.net/{deep}/y/7/z", f"http://deep.net/{deep}", "http://lone.net/" + "q/" * 40]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    labelled = spark.createDataFrame([(i, i % 2) for i in range(60)], "page_id long, bad int")
    got = {r.page_id: r for r in url_filter.judge(pages, labelled).collect()}
    assert [got[i].verdict for i in range(60)] == ["allow", "block"] * 30
    assert [got[i].template for i in range(60, 64)] == [f"/{deep}/x", f"/{deep}/y/*/z", f"/{deep}", "/q" * 40]
    r = random.Random(11)
    rows = [(i, f"http://h{i % 3}.net" + "".join(f"/{r.choice(WORDS[: r.choice([2, 60])])}" for _ in range(r.randint(0, 6)))) for i in range(600)]
    marks = [(i, int(r.random() < 0.5)) for i in range(400)]
    pages, labelled = spark.createDataFrame(rows, "page_id long, url string"), spark.createDataFrame(marks, "page_id long, bad int")
    con = duckdb.connect()
    con.register("marks", labelled.toPandas())
    con.register("shown", pages.toPandas())
    same(url_filter.judge(pages, labelled), con, url_filter.judge_sql("shown", "marks"))


def test_tool_calls(spark):
    schemas = {"add": {"type": "object", "required": ["x"], "properties": {"x": {"type": "integer", "minimum": 0}}, "additionalProperties": False}}
    m = [
        ("c", 0, "call", "assistant", "add", "b", '{"x":1}', None, ["a"]), ("c", 1, "result", "tool", None, "a", None, "3", []), ("c", 2, "call", "assistant", "add", "a", '{"y":2, "x":1}', None, []),
        ("c", 3, "result", "tool", None, "zz", None, None, []), ("c", 4, "message", "user", None, None, None, "hé", None), ("c", 5, "call", "assistant", "sub", "p", "{}", None, ["q"]),
        ("c", 6, "call", "assistant", "add", "q", "no json", None, ["p"]), (None, 7, "call", None, None, None, None, None, None), ("c", 4, "message", "user", None, None, None, "hé", None),
    ]
    frame = spark.createDataFrame(m, "conv string, pos long, kind string, role string, name string, call_id string, arguments string, content string, depends_on array<string>")
    rows = tool_calls.format_chats(frame, schemas).orderBy("anchor", "level", "pos").collect()
    assert len(rows) == len(m)
    by = {(r.pos, r.kind): r for r in rows}
    order = [(r.kind, r.call_id) for r in rows if r.call_id in ("a", "b")]
    assert order == [("call", "a"), ("result", "a"), ("call", "b")]
    assert by[1, "result"].linked and by[2, "call"].linked and not by[3, "result"].linked and not by[0, "call"].linked
    assert by[2, "call"].errors == ["$.y: unknown"] and by[0, "call"].valid and by[5, "call"].cyclic and by[6, "call"].errors == ["$: not JSON"]
    assert by[2, "call"].message == '{"role":"assistant","tool_call":{"arguments":{"x":1,"y":2},"id":"a","name":"add"}}'
    assert tool_calls.format_chats(frame.limit(0), schemas).count() == 0


def test_results_are_placed_by_the_order_of_messages(spark, tmp_path, monkeypatch):
    """Results depend on their calls; without that stage op2 would put them elsewhere."""
    calls = spark.createDataFrame([("c", "a", 4, [], 5), ("c", "b", 0, ["a"], 1), ("d", "a", 2, [], None)], "conv string, call_id string, pos long, depends_on array<string>, result_pos long")
    got = {(r.conv, r.call_id, r.kind): (r.anchor, r.level, r.cyclic) for r in tool_calls.ordered_messages(calls).collect()}
    assert got == {("c", "a", "call"): (4, 0, False), ("c", "a", "result"): (4, 1, False), ("c", "b", "call"): (5, 2, False), ("c", "b", "result"): (5, 3, False), ("d", "a", "call"): (2, 0, False), ("d", "a", "result"): (2, 1, False)}
    turns = [(1, 0, "system", "s"), (1, 1, "user", "q"), (1, 2, "assistant", "a"), (1, 3, "assistant", "b"), (2, 0, "user", "q")]
    spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    found = lambda: sorted((r.conv_id, r.turn, r.anchor, r.level) for r in queries.op2_tool_calls(spark, str(tmp_path)).collect())
    assert found() == [(1, 0, 0, 0), (1, 1, 1, 0), (1, 2, 2, 1), (1, 3, 3, 0), (2, 0, 0, 0)]
    ordered = tool_calls.ordered_messages
    monkeypatch.setattr(tool_calls, "ordered_messages", lambda calls: ordered(calls).where("kind = 'call'"))
    assert found() == [(1, 0, 0, 0), (1, 1, 1, 0), (1, 2, 2, 0), (1, 3, 3, 0), (2, 0, 0, 0)]


def test_odd_tool_calls(spark):
    """Lone surrogates, deep nesting, numbers that JSON lacks, ties, long texts and columns of clashing names."""
    schemas = {"f": {"type": "object"}, "g": {"type": "string", "minLength": 2}}
    long = prose(20_000, 5)
    m = [
        ("c", 0, "call", "a", "f", "s", '{"k\\ud800":"\\ud800"}', None, []), ("c", 1, "call", "a", "f", "d", "[" * 5000 + "]" * 5000, None, []), ("c", 2, "call", "a", "f", "m", "[" * 99 + "]" * 99, None, []),
        ("c", 3, "call", "a", "f", "n", '{"x":NaN}', None, []), ("c", 4, "call", "a", "g", "l", '"' + long + '"', None, []), ("c", 5, "result", "t", None, "l", None, long, []),
        ("c", 6, "call", "a", "f", "t", "{}", None, ["l"]), ("c", 6, "call", "a", "f", "t", "{}", None, ["d"]), ("c", 7, "call", "a", "f", "t", "{}", None, []),
    ]
    schema = "conv string, pos long, kind string, role string, name string, call_id string, arguments string, content string, depends_on array<string>"
    frame = spark.createDataFrame(m, schema).selectExpr("*", "1 as c", "2 as i", "'x' as linked", "'x' as anchor", "3 as level", "'x' as w")
    rows = tool_calls.format_chats(frame, schemas).collect()
    assert len(rows) == len(m)
    by = {r.call_id: r for r in rows if r.kind == "call"}
    assert by["s"].message == '{"role":"a","tool_call":{"arguments":{"k\\ud800":"\\ud800"},"id":"s","name":"f"}}' and by["s"].valid
    assert by["d"].errors == ["$: nested too deep"] and by["m"].errors == ["$: not object"] and by["n"].errors == ["$: not JSON"] and by["l"].valid and long in by["l"].message
    assert {(r.anchor, r.level) for r in rows if r.call_id == "t"} == {(6, 2), (7, 2)}  # the smaller dependencies: d


def brute_toxicity(net, text):
    """The highest window, computed word by word."""
    h, words = toxicity.HIDDEN, toxicity.terms(text)
    p = net.p

    def enter(word):
        ids = [net.grams.get(g, 0) for g in toxicity.grams(word)]
        return np.concatenate([p["ew"][net.words.get(word, 0)], p["eg"][ids].mean(0)])

    def read(d, xs):
        state, out = np.zeros(h), []
        for x in xs:
            a, b = x @ p["x" + d] + p["c" + d], state @ p["h" + d]
            r, z = 1 / (1 + np.exp(-(a[:h] + b[:h]))), 1 / (1 + np.exp(-(a[h : 2 * h] + b[h : 2 * h])))
            state = (1 - z) * np.tanh(a[2 * h :] + r * b[2 * h :]) + z * state
            out.append(state)
        return out

    best = 0.0
    for start in range(0, max(1, len(words) - toxicity.WINDOW + toxicity.STEP), toxicity.STEP) if words else ():
        xs = [enter(w) for w in words[start : start + toxicity.WINDOW]]
        states = [np.concatenate(s) for s in zip(read("f", xs), read("b", xs[::-1])[::-1])]
        e = np.exp([s @ p["att"] for s in states])
        best = max(best, 1 / (1 + np.exp(-(sum(w * s for w, s in zip(e / e.sum(), states)) @ p["out"] + p["bias"][0]))))
    return best


def test_toxicity_equals_brute_force(spark):
    """Whole texts, in all their overlapping windows, of the query's rows."""
    texts = [prose(n, 40 + n) + (" zorgon" if n % 3 == 0 else "") for n in (1, 5, 31, 32, 33, 47, 48, 49, 64, 100, 400)] + ["", "?!"]
    rows = [(i, t) for i, t in enumerate(texts * 3)]
    marks = spark.createDataFrame([(i, int("zorgon" in t)) for i, t in rows], "doc_id long, toxic int")
    docs = table(spark, rows)
    net = toxicity.fit(docs, marks)
    got = {r.doc_id: r.score for r in toxicity.rate_toxicity(docs, marks).collect()}
    assert all(abs(got[i] - brute_toxicity(net, t)) < 1e-4 for i, t in rows) and len(set(got.values())) > 5


def test_toxicity_learns_from_a_bounded_sample(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(toxicity, "train", lambda texts, labels: seen.append((texts, labels)))
    rows = [(i, f"w{i} " * 50) for i in range(400)] + [(1, f"other {i}") for i in range(300)]
    marks = spark.createDataFrame([(i, i % 2) for i in range(400)], "doc_id long, toxic int")
    toxicity.fit(table(spark, rows), marks, max_docs=60)
    toxicity.fit(table(spark, rows), marks, max_docs=400, max_bytes=20_000)
    assert 60 < len(seen[0][0]) < 180 and 0 < sum(map(len, seen[1][0])) < 40_000
