"""Token counts, packing, mixing, language, quality and the pipeline."""

import itertools
import math
import zlib
from collections import Counter, defaultdict
from functools import cache, partial

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from monthclose.llm import language, line_quality, mixing, packing, token_counts, tokens

from .conftest import ROWS

TRICKY = [
    "", " ", "a", " a", "a  b", "a \n b", "\ttab", "▁", "a▁ b", "a ▁b", "x▁▁ y", "é" * 70, "<s> </s> <unk>",
    "<|endoftext|>", "a<|endoftext|> b", "don't  stop", "1 234 567", "word\r\n", "   ", "end ", "日本 語", "  nbsp",
]


def test_token_counts(spark, docs, nothing):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    df = docs.select("doc_id", "text").union(spark.createDataFrame(list(enumerate(TRICKY, 100)), "doc_id long, text string"))
    found = token_counts.token_counts(df, limit=20, entries=5).collect()
    want = Counter()
    for i, text in [(i, t) for i, t, *_ in ROWS] + list(enumerate(TRICKY, 100)):
        n = len(model.encode(text or ""))
        want[(i, len((text or "").encode()), n, n > 20)] += 1
    assert Counter(map(tuple, found)) == want
    assert token_counts.token_counts(nothing).count() == 0


@cache
def whole_tokenizer():
    import tokenizers

    return tokenizers.Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def ids_of(text):
    return np.array(whole_tokenizer().encode(text or "", add_special_tokens=False).ids, "<u4")


def test_ids_equal_the_tokenizer():
    encode = tokens.byte_bpe(tokens.Vocabulary.from_files())
    for text in [*TRICKY, *[t or "" for _, t, *_ in ROWS]]:
        assert encode(text) == ids_of(text).tobytes(), repr(text)


def test_packing(docs, nothing):
    limits = packing.Limits(tokens=64, segments=4, loss=64)
    pieces = packing.pack_documents(docs.where("doc_id IS NOT NULL AND doc_id <> 1"), limits=limits, window=3).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
    for i, text, *_ in ROWS:
        if i in (None, 1):
            continue
        ids, at = np.append(ids_of(text), 0).astype("<u4"), 0
        for p in sorted(by_doc[i], key=lambda p: p.start):
            assert (p.start, p.doc_tokens) == (at, len(ids))
            assert p.ids_crc32 == zlib.crc32(ids[at : at + p.length].tobytes())
            at += p.length
        assert at == len(ids)
    for parts in by_sequence.values():
        at = 0
        for p in sorted(parts, key=lambda p: p.offset):
            assert p.offset == at and p.length > 0
            at += p.length
        assert at <= 64 and len(parts) <= 4
    assert packing.pack_documents(nothing).count() == 0


def test_packing_of_instruction_data(spark, nothing):
    """Prompts bear no loss: a sequence may be full by its loss-bearing tokens while there is room for more."""
    draw = np.random.default_rng(3)
    word = lambda n: " ".join(draw.choice(["alpha", "beta", "gamma", "é"], n))
    rows = [(i, word(int(draw.integers(0, 60))), word(int(draw.integers(0, 60)))) for i in range(300)]
    rows += [(300, None, None), (301, "only a prompt " * 80, None), (302, None, "only a response " * 80)]
    limits = packing.Limits(tokens=128, segments=6, loss=48)
    df = spark.createDataFrame(rows, "doc_id long, prompt string, response string")
    pieces = packing.pack_examples(df.withColumn("ids", F.col("doc_id")), limits=limits, window=50).collect()
    by_doc, loads = defaultdict(list), defaultdict(lambda: [0, 0, 0])
    for p in pieces:
        by_doc[p.doc_id].append(p)
        load = loads[p.sequence_id]
        for k, more in enumerate((p.length, 1, p.loss_tokens)):
            load[k] += more
    for i, prompt, response in rows:
        before = ids_of(prompt)
        ids, at, loss = np.concatenate([before, ids_of(response), [0]]).astype("<u4"), 0, 0
        for p in sorted(by_doc[i], key=lambda p: p.start):
            assert p.start == at and p.ids_crc32 == zlib.crc32(ids[at : at + p.length].tobytes())
            at, loss = at + p.length, loss + p.loss_tokens
            assert p.loss_tokens == len(range(max(p.start, len(before)), at))
        assert at == len(ids) == p.doc_tokens and loss == len(ids) - len(before)
    assert all(a <= 128 and b <= 6 and c <= 48 for a, b, c in loads.values())
    assert sum(c == 48 and a < 128 for a, _, c in loads.values()) > 10
    empty = nothing.selectExpr("doc_id", "text AS prompt", "text AS response")
    assert packing.pack_examples(empty).count() == 0


@pytest.mark.parametrize("seed", range(4))
def test_packer_keeps_all_limits(seed):
    draw = np.random.default_rng(seed)
    limits = packing.Limits(tokens=128, segments=6, loss=70)
    packer = packing.Packer(limits, window=40)
    sizes = {}
    for i in range(300):
        n = int(draw.integers(1, 400))
        sizes[i] = (n, int(draw.integers(0, n + 1)))
        packer.add(i, *sizes[i])
    packer.finish()
    seen, loads = defaultdict(list), defaultdict(lambda: [0, 0, 0])
    for i, start, length, sequence, offset in packer.done:
        seen[i].append((start, length))
        load = loads[sequence]
        assert offset <= 128
        load[0] += length
        load[1] += 1
        load[2] += max(0, start + length - max(start, sizes[i][1]))
    assert all(a <= 128 and b <= 6 and c <= 70 for a, b, c in loads.values())
    for i, (n, _) in sizes.items():
        at = 0
        for start, length in sorted(seen[i]):
            assert start == at
            at += length
        assert at == n


def shared_out(sizes, weights=(5, 2, 1), share=1.5, limit=2):
    """Targets by handing the excess on, round after round."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    target, left, capped = {}, share * sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in capped]
        total = sum(weight[s] for s in free)
        for s in free:
            target[s] = left * weight[s] / total
        over = [s for s in free if target[s] > limit * sizes[s]]
        if not over:
            return target
        for s in over:
            target[s] = limit * sizes[s]
            left -= target[s]
            capped.add(s)


def test_mix_hits_its_targets(spark, docs, nothing):
    draw = np.random.default_rng(1)
    rows = [
        (i, " ".join(["w"] * int(draw.integers(1, 60))), [None, "", "a", "b", "c", "d"][int(draw.choice(6, p=[0.1, 0.1, 0.4, 0.2, 0.1, 0.1]))])
        for i in range(1500)
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = {r.doc_id: r for r in mixing.mix(df).collect()}
    again = {r.doc_id: r.taken for r in mixing.mix(df.repartition(7)).collect()}
    sizes, taken = Counter(), Counter()
    for i, text, source in rows:
        n = len(text.split(" "))
        assert found[i].size == n and found[i].taken in (0, n, 2 * n) and found[i].taken == again[i]
        sizes[source] += n
        taken[source] += found[i].taken
    want = shared_out(sizes)
    for i, _, source in rows:
        assert found[i].source_size == sizes[source] and abs(found[i].target - want[source]) < 1e-6
    assert all(abs(taken[s] - want[s]) <= 60 for s in want)
    copied = Counter(r.doc_id for r in mixing.mixed_rows(df).collect())
    assert all(copied[i] * found[i].size == found[i].taken for i in found)
    assert mixing.mix(docs).count() == len(ROWS) and mixing.mix(nothing).count() == 0
    assert mixing.mixed_rows(docs).columns == docs.columns and mixing.mixed_rows(nothing).count() == 0


def rates_by_bisection(sizes, target, limit=2):
    """One multiplier for a source, so that the tilted rates meet its target."""
    x = np.array(sizes, float)
    if target >= limit * x.sum():
        return np.full(len(x), float(limit))
    low, high = -50.0, 50.0
    for _ in range(200):
        tilt = (low + high) / 2
        rate = np.minimum(limit, np.exp(np.clip(tilt * x / x.max(), None, 50)))
        low, high = (tilt, high) if (rate * x).sum() < target else (low, tilt)
    return rate


def test_mix_follows_the_tilted_rates(spark, monkeypatch):
    """Sizes over many ranges, a class with a third of all rows dealt into parts: copies of equal sizes follow the
    rates that plain bisection gives, and each source ends within half its smallest documents of its target."""
    monkeypatch.setattr(mixing, "hot_classes", partial(mixing.hot_classes, share=1 / 50))
    draw = np.random.default_rng(7)
    drawn = [("abcde"[int(draw.integers(5))], int(2 ** draw.uniform(0, 11.5))) for _ in range(2000)] + [("a", 33)] * 1000
    rows = [(i, "w " * n, source) for i, (source, n) in enumerate(drawn)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    found = {r.doc_id: r for r in mixing.mix(df).collect()}
    _, sizes, _, hot = mixing.balanced(df)
    assert hot.count() >= 1 and sizes.where("source = 'a' AND size = 33").select("part").distinct().count() > 10
    want = shared_out({s: sum(n for t, n in drawn if t == s) for s in "abcde"})
    for source in "abcde":
        mine = [i for i, (s, _) in enumerate(drawn) if s == source]
        taken = sum(found[i].taken for i in mine)
        assert abs(taken - want[source]) <= min(drawn[i][1] for i in mine)
        copies, rates = Counter(), Counter()
        for i, rate in zip(mine, rates_by_bisection([drawn[i][1] for i in mine], want[source]), strict=True):
            copies[drawn[i][1]] += found[i].taken // drawn[i][1]
            rates[drawn[i][1]] += rate
        assert all(abs(copies[n] - rates[n]) <= 3 for n in rates if n >= 256)
        assert source != "a" or abs(copies[33] - rates[33]) <= 0.05 * rates[33] + 3


@pytest.mark.parametrize("bits", [1, 2, 7])
def test_ranges_of_size(spark, monkeypatch, bits):
    monkeypatch.setattr(mixing, "RANGE_BITS", bits)
    bands = spark.range(1, 5000).select("id", mixing.range_of(F.col("id")).alias("band")).orderBy("id").collect()
    assert [r.band for r in bands] == sorted(r.band for r in bands)
    per_band = Counter(r.band for r in bands)
    assert all(per_band[r.band] == 1 for r in bands if r.id < 1 << bits)
    assert len(per_band) <= 13 << (bits - 1) and max(per_band.values()) <= 4096 >> (bits - 1)


def test_language(spark, docs, nothing):
    draw = np.random.default_rng(0)
    words = {"en": ["the", "and", "with", "house"], "de": ["und", "der", "straße", "haus"], "fr": ["être", "le", "avec", "maison"]}
    rows = [(i, " ".join(draw.choice(words[lang], 12)), lang) for i in range(300) for lang in [list(words)[i % 3]]]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = language.languages(df).collect()
    assert np.mean([rows[r.doc_id][2] == r.lang_pred for r in found if r.held_out]) > 0.98
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in found)
    odd = Counter((r.doc_id, r.lang_pred == "und") for r in language.languages(docs).collect())
    assert odd == Counter((i, not (t and any(c.isalpha() for c in t))) for i, t, *_ in ROWS)
    assert language.languages(nothing).count() == 0
    unlabelled = language.languages(df.withColumn("lang", df.lang.substr(1, 0)).where("doc_id < 9").selectExpr("doc_id", "text", "cast(null AS string) AS lang"))
    assert {r.lang_pred for r in unlabelled.collect()} == {"und"}


def brute_marginals(good, step, first):
    from itertools import product

    total, p = 0.0, np.zeros(len(good))
    for states in product((0, 1), repeat=len(good)):
        score = first[states[0]] + sum(g * s for g, s in zip(good, states, strict=True))
        score += sum(step[a][b] for a, b in zip(states, states[1:], strict=False))
        total += np.exp(score)
        p += np.exp(score) * np.array(states)
    return p / total


def test_marginals_equal_all_paths():
    draw = np.random.default_rng(3)
    step, first = draw.normal(size=(2, 2)), draw.normal(size=2)
    chains = [draw.normal(size=n) for n in (6, 4, 4, 1)]
    p, pairs, starts = line_quality.marginals(np.concatenate(chains), np.array([6, 4, 4, 1]), step, first)
    assert np.allclose(p, np.concatenate([brute_marginals(c, step, first) for c in chains]))
    assert np.isclose(pairs.sum(), 5 + 3 + 3) and np.isclose(starts.sum(), 4)


def test_quality(spark, docs, nothing):
    draw = np.random.default_rng(6)
    rows = []
    for i in range(240):
        word = (lambda: "plain") if i % 3 else (lambda: "$$%%##")
        rows.append((i, "\n".join(" ".join(word() + str(draw.integers(9)) for _ in range(6)) for _ in range(4))))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 > 0)) for i in range(240)] + [(0, None), (None, 1)], "doc_id long, quality int")
    found = line_quality.quality(df, labels).collect()
    assert all(r.predicted == int(r.doc_id % 3 > 0) for r in found if r.held_out)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in found)
    odd = line_quality.quality(docs, labels).collect()
    assert len(odd) == len(ROWS) and all(0 <= r.score <= 1 for r in odd)
    assert line_quality.quality(nothing, labels).count() == 0
    assert {r.score for r in line_quality.quality(docs, labels.where("doc_id < 0")).collect()} == {0.5}


def _share_by_paths(field, text):
    """Share of good text from every sequence of states, each line read alone beside its neighbours."""
    rows, lengths = line_quality.line_features(text)
    good = rows.astype(float) @ field.weights
    weight = {}
    for states in itertools.product((0, 1), repeat=len(rows)):
        score = field.first[states[0]] + sum(good[i] for i, y in enumerate(states) if y)
        weight[states] = math.exp(score + sum(field.step[a, b] for a, b in itertools.pairwise(states)))
    per_line = [sum(w for y, w in weight.items() if y[i]) / sum(weight.values()) for i in range(len(rows))]
    return float(np.average(per_line, weights=lengths))


def test_quality_scores_against_all_paths(spark):
    """The query's score, step by step: learnt field, marginals by enumeration, weight by length, curve."""
    draw = np.random.default_rng(8)
    words = ["plain", "Words", "$$%%", "12 34", "", "the end."]
    texts = ["\n".join(" ".join(draw.choice(words, 4)) for _ in range(int(draw.integers(1, 7)))) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, int("$" not in t)) for i, t in enumerate(texts)], "doc_id long, quality int")
    known = labels.where(line_quality.crc_share("doc_id", 5) != 0)
    field = line_quality.train(df, known)
    for row in line_quality.quality(df, labels).collect():
        share = min(max(_share_by_paths(field, texts[row.doc_id]), 1e-6), 1 - 1e-6)
        want = 1 / (1 + math.exp(-(field.slope * math.log(share / (1 - share)) + field.offset)))
        assert abs(row.score - want) < 1e-4 and row.predicted == int(row.score >= 0.3)


def test_quality_learns_from_any_stretch(spark):
    """A text of many lines is learnt from wherever it stands; a bound on lines draws whole stretches evenly."""
    lines = [f"line {i}" for i in range(64 * 40)]
    batch = pa.RecordBatch.from_arrays([pa.array([1, 0], pa.int32()), pa.array(["\n".join(lines), None])], names=["quality", "text"])
    every = next(line_quality._chunks(1.0)([batch])).to_pylist()
    assert len(every) == 41 and sum(len(r["rows"]) for r in every) == (64 * 40 + 1) * line_quality.FEATURES * 4
    some = next(line_quality._chunks(0.5)([batch])).to_pylist()
    assert 10 < len(some) < 31 and {(r["draw"], r["rows"]) for r in some} < {(r["draw"], r["rows"]) for r in every}
    good = "\n".join(["plain words of text."] * 700)
    bad = "\n".join(["plain words of text."] * 10 + ["$$ %% ## 77"] * 690)
    rows = [(i, good if i % 2 else bad) for i in range(40)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    found = line_quality.quality(df, labels, sample_lines=4000).collect()
    assert all(r.predicted == r.doc_id % 2 for r in found)


def test_pipeline_stages(spark, docs, nothing, tmp_path):
    import corpus_pipeline

    now, kept = docs, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, now, "")
        assert out.columns == docs.columns
        out.write.parquet(f"{tmp_path}/{name}")
        now = spark.read.parquet(f"{tmp_path}/{name}")
        kept[name] = Counter(r.doc_id for r in now.collect())
    assert set(kept["language"]) == {i for i, t, *_ in ROWS if t and any(c.isalpha() for c in t)}
    assert kept["exact_dedup"][2] == 1 and kept["exact_dedup"][1] == 1  # alike but for case: no exact copies
    assert max(kept["near_dedup"].values()) == 1 and kept["near_dedup"][2] == 0
    assert max(kept["mix"].values()) <= 2
    assert corpus_pipeline.STAGES[-1][1](spark, now, "").count() >= sum(kept["mix"].values())
    empty = nothing
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, "")
    assert empty.count() == 0


INNER = ["row", "found", "__size", "__copy", "__key_a", "__repeated", "__lang", "size", "part", "draw", "copies", "n", "fp", "s"]


def test_stages_leave_columns_with_inner_names_alone(spark, docs):
    """Extra columns named as those a stage computes come back with their values."""
    import corpus_pipeline

    extra = docs.select("doc_id", "text", "lang", "source", *[F.concat(F.lit(f"{c} "), "key").alias(c) for c in INNER])
    before = {tuple(r) for r in extra.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, extra, "")
        assert out.columns == extra.columns, name
        after = [tuple(r) for r in out.collect()]
        assert after and set(after) <= before, name
    assert corpus_pipeline.STAGES[-1][1](spark, extra, "").count() >= len(before)


def test_near_copy_stage_keeps_one_of_each_component(spark, docs):
    import corpus_pipeline
    from monthclose.llm import simhash

    named = simhash.near_duplicates(docs).collect()
    kept = corpus_pipeline.drop_near_copies(spark, docs, "").collect()
    assert sorted(r.doc_id or -1 for r in kept) == sorted({r.component_id or -1 for r in named})


def test_pipeline_removes_what_it_no_longer_needs(spark, tmp_path, monkeypatch):
    import corpus_pipeline

    rows = [(i, f"plain text number {i} with some more words " * (1 + i % 3), "en", "a") for i in range(40)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    monkeypatch.setattr(corpus_pipeline, "shared_folder", lambda spark: f"{tmp_path}/shared")
    found = corpus_pipeline.run(spark, str(tmp_path))
    assert found.count() > 0
    (folder,) = (tmp_path / "shared").iterdir()
    assert {p.name for p in folder.iterdir()} == {"mix"}
