from __future__ import annotations

import itertools
import os
import random
import re
import struct
import zlib
from hashlib import blake2b, sha256

import numpy as np
import public_tokenizers as P
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm import brute
from tradelake.llm import (
    bpe,
    co_training,
    decontam,
    maglev,
    near_dup,
    perfect_hash,
    quality_rules,
    samples,
    shards,
    suffix_dedup,
    token_files,
    toxic_crf,
    warc,
)
from tradelake.llm.scratch import Scratch

SCHEMA = "doc_id long, text string"
RANKS, TOKENIZER = P.path("byte_bpe_50k.tiktoken"), P.path("byte_bpe_50k.json")
ODD_TEXTS = [
    "a", "the", "'", "'s", "'re", " ", "  ", "\n", "\t", "é", "ß", "1", "23", "!", "...", "\xa0",
    "　", "漢字", "🙂", "word", "\r\n", "ll", "<|endoftext|>", ".\n",
]


def by_text(rows):
    return sorted(rows, key=str)


# -- 1


def test_bpe_joins_equal_whole_texts(monkeypatch):
    own = bpe.codec(RANKS, P.PATTERN)
    rnd = random.Random(1)
    monkeypatch.setattr(bpe, "BLOCK", 5)
    for window in (1, 2, 8):
        monkeypatch.setattr(bpe, "WINDOW", window)
        for _ in range(1500):
            text = "".join(rnd.choice(ODD_TEXTS) for _ in range(rnd.randint(0, 50)))
            assert own.encode(text).ids.tolist() == own._encoding.encode_ordinary(text)


def test_bpe_table(spark):
    long = "word " * 40_000 + "a" * 9000
    docs = [(1, "Hello, it's  2024\n"), (2, ""), (3, None), (None, "x"), (1, "Hello"), (1, "Hello"), (4, long)]
    df = spark.createDataFrame(docs, SCHEMA).withColumn("ids", F.lit(5)).withColumn("n_tokens", F.lit("x"))
    made = bpe.decode(bpe.encode(df, RANKS, P.PATTERN), RANKS, P.PATTERN)
    got = [(r.row.doc_id, r.n_tokens, bytes(r.ids), bytes(r.decoded)) for r in made.collect()]
    encoding = bpe.codec(RANKS, P.PATTERN)._encoding
    wanted = []
    for ident, text in docs:
        ids = encoding.encode_ordinary(text or "")
        wanted.append((ident, len(ids), np.array(ids, "<u4").tobytes(), (text or "").encode()))
    assert by_text(got) == by_text(wanted)
    assert bpe.encode(df.limit(0), RANKS, P.PATTERN).count() == 0


# -- 2


def test_warc_round_trip_is_deterministic(spark):
    rows = [
        (i, f"http://x/{i % 50}", None if i % 9 == 0 else f"p{i % 7}" * (i % 7 * 30))
        for i in range(150)
    ] + [(None, None, "p3" * 90), (5, "u\r\nv", "p5" * 150), (5, "u", "p5" * 150)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    contents = []
    for tasks in (2, 5):
        folder = Scratch(spark, "warc-test").path("archives")
        manifest = warc.write_archives(df.repartition(tasks), folder, roll_bytes=3000, shard_number=3)
        assert sum(f.records for f in manifest) == len(rows) and len(manifest) > 3
        found = warc.read_archives(spark, folder).collect()
        names = sorted(n for n in os.listdir(folder) if n.endswith(".gz"))
        assert names == sorted(f.file for f in manifest)
        contents.append([sha256(open(f"{folder}/{n}", "rb").read()).hexdigest() for n in names])
    assert contents[0] == contents[1]
    first = {}
    for page, _, html in rows:
        if page is not None and len(html or "") >= 100:
            first[html] = min(first.get(html, page), page)
    wanted = []
    for page, _, html in rows:
        raw = (html or "").encode()
        target = first.get(html, page)
        kind = ("revisit", target) if target != page else ("response", None)
        wanted.append((page, len(raw), sha256(raw).hexdigest(), *kind))
    got = [
        (r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found
    ]
    assert by_text(got) == by_text(wanted)
    folder = Scratch(spark, "warc-test").path("none")
    assert warc.write_archives(df.limit(0), folder) == []
    assert warc.read_archives(spark, folder).count() == 0


def test_warc_with_clashing_columns_and_a_long_record(spark):
    long = "long record " * 200_000
    rows = [(1, "u", "a" * 200, "x", 7), (2, "v", "a" * 200, None, 8), (3, None, long, "y", None)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, digest string, kind int")
    folder = Scratch(spark, "warc-test").path("archives")
    manifest = warc.write_archives(df, folder, roll_bytes=1000, shard_number=2)
    assert sum(f.records for f in manifest) == 3
    found = {r.page_id: r for r in warc.read_archives(spark, folder).collect()}
    assert [found[i].record_type for i in (1, 2, 3)] == ["response", "revisit", "response"]
    assert found[2].refers_to == 1 and found[3].payload_bytes == len(long)
    assert bytes(found[3].payload).decode() == long


def test_shards_split_the_rows_of_a_hot_key_in_order(spark):
    far = 2**62
    rows = [(None, i * 7919 % 1000) for i in range(300)] + [(far, i) for i in range(300)]
    rows += [(far + i, 5) for i in range(1, 150)] + [(i - 75, 0) for i in range(150)] + [(3, 3)] * 200
    df = spark.createDataFrame(rows, "key long, tie long")
    sharded = shards.with_shard(df, "key", 8, tie=F.col("tie"))
    got = [(r.shard, r.key is not None, r.key or 0, r.tie) for r in sharded.collect()]
    by_key = [g[0] for g in sorted(got, key=lambda g: g[1:])]
    assert by_key == sorted(by_key)
    different = {g[1:]: g[0] for g in got}
    sizes = np.bincount(list(different.values()), minlength=8)
    assert sizes.min() > 0 and sizes.max() < 2.5 * len(different) / 8
    assert len({s for k, s in different.items() if not k[0]}) > 1
    tasks = shards.in_shards(sharded, 8, "key", "tie").select("shard", F.spark_partition_id().alias("task"))
    assert all(r.shard == r.task for r in tasks.distinct().collect())
    whole = {r.key: r.shard for r in shards.with_shard(df, "key", 8).distinct().collect()}
    assert len(whole) == len({k for k, _ in rows})
    assert shards.with_shard(df.limit(0), "key", 8, tie=F.col("tie")).count() == 0


# -- 3


def repeating_docs():
    rnd = random.Random(3)
    passages = ["".join(rnd.choice("abcdeé ") for _ in range(rnd.randint(20, 300))) for _ in range(12)]
    docs = []
    for i in range(60):
        parts = [
            rnd.choice(passages)
            if rnd.random() < 0.6
            else "".join(rnd.choice("xyz ") for _ in range(rnd.randint(1, 40)))
            for _ in range(rnd.randint(0, 8))
        ]
        docs.append((i, "".join(parts)))
    return docs + [
        (80, None), (81, "a" * 500), (82, "ab" * 400), (3, docs[3][1]), (3, docs[4][1]),
        (None, docs[5][1]), (None, None),
    ]


@pytest.mark.parametrize(("length", "prefix", "batches"), [(40, 24, 4), (100, 60, 1), (60, 20, 3)])
def test_suffix_dedup_equals_brute_force(spark, length, prefix, batches):
    docs = repeating_docs()
    df = spark.createDataFrame(docs, SCHEMA).withColumn("tag", F.lit(1)).withColumn("spans", F.lit("x"))
    cut = suffix_dedup.remove_repeats(df, length=length, prefix=prefix, batches=batches)
    got = [(r.row.doc_id, bytes(r.kept), len(r.spans)) for r in cut.collect()]
    assert by_text(got) == by_text(brute.without_repeats(docs, length))


def test_suffix_dedup_keeps_characters_whole_and_takes_no_rows(spark):
    df = spark.createDataFrame(repeating_docs(), SCHEMA)
    cut = suffix_dedup.remove_repeats(df, length=41, prefix=20, whole_chars=True)
    assert all(bytes(r.kept).decode() is not None for r in cut.collect())
    assert suffix_dedup.remove_repeats(df.limit(0)).count() == 0


def test_suffix_dedup_lists_spans_of_repeated_rows_once(spark):
    rnd = random.Random(4)
    text = "".join(rnd.choice("abcdef ") for _ in range(1500))
    docs = [(None, text)] * 3000 + [(1, text)] * 1000 + [(2, "short")]
    df = spark.createDataFrame(docs, SCHEMA)
    spans = suffix_dedup.repeated_spans(df).collect()
    assert len(spans) == 2 and all(len(r.spans) == len(set(r.spans)) for r in spans)
    cut = suffix_dedup.remove_repeats(df)
    got = {tuple(r) for r in cut.select("row.doc_id", F.length("kept"), F.size("spans")).collect()}
    assert cut.count() == len(docs) and got == {(None, 0, 1), (1, 0, 1), (2, 5, 0)}


# -- 4


def test_quality_rules_on_odd_texts(spark):
    repeat = "one two three four five six seven eight "
    docs = [
        (1, None), (2, ""), (3, " \n\t"), (4, repeat * 2), (5, repeat + "nine"),
        (6, "the cat sat\n" * 30), (None, "the " + "word " * 30), (7, "## $$ " * 30),
        (7, "the good cat sat on a long mat and it saw two more of them there with his dog at home"),
        (8, "word " * 30_000),
    ]
    df = spark.createDataFrame(docs, SCHEMA).withColumn("quality", F.lit("clash"))
    for row in quality_rules.apply_rules(df).collect():
        text, q = row.text or "", row.quality
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
        often = {w for w in set(windows) if windows.count(w) > 1} if len(windows) < 999 else set(windows)
        covered = {i + j for i, w in enumerate(windows) if w in often for j in range(8)}
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        assert (q.n_words, q.word_chars) == (len(words), sum(map(len, words)))
        assert (q.n_repeat_words, q.n_dup_lines) == (len(covered), len(lines) - len(set(lines)))
        assert q.n_symbols == len(re.findall(r"[#*$%&|<>]", text))
        assert q.base_failed == (len(words) < 20 or 100 * len(covered) > 30 * len(words))
        assert not (q.kept and q.base_failed)
    assert quality_rules.apply_rules(df.limit(0)).count() == 0


def test_quality_rules_plan_has_no_python(spark, sf):
    made = quality_rules.apply_rules(spark.read.parquet(f"{sf}/documents.parquet"))
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange" not in plan


# -- 5


@pytest.mark.parametrize("block", [32 << 20, 600])
def test_decontamination_equals_brute_force(spark, monkeypatch, block):
    rnd = random.Random(5)
    vocabulary = [f"w{i}" for i in range(25)] + ["é", "A1"]
    items = [
        (i, " ".join(rnd.choice(vocabulary) for _ in range(rnd.choice([0, 1, 3, 9, 10, 11, 30]))))
        for i in range(25)
    ] + [(None, "w1 w2"), (99, None), (7, "w1 w1 w2 w3")]
    docs = []
    for i in range(80):
        parts = []
        for _ in range(rnd.randint(0, 6)):
            own = (rnd.choice(items)[1] or "").split()
            start = rnd.randint(0, 5)
            parts += own[start : start + rnd.randint(8, 20)] or [rnd.choice(vocabulary)]
        docs.append((i, rnd.choice(["  ", "-", "\n"]).join(parts)))
    docs += [(500, None), (3, docs[3][1]), (None, "w1 w1 w2 w3")]
    monkeypatch.setattr(decontam, "BLOCK_BYTES", block)
    df = spark.createDataFrame(docs, SCHEMA).withColumn("spans", F.lit(1))
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontam.find_contamination(df, bench).collect()
    got = [(r.id, r.n_words, r.n_hit, tuple(r["items"])) for r in found]
    assert by_text(got) == by_text(brute.contamination(docs, items))
    assert all(set(r["items"]) <= set(r.near_items) for r in found)
    assert decontam.find_contamination(df.limit(0), bench).count() == 0
    assert decontam.find_contamination(df, bench.limit(0)).filter("n_hit > 0").count() == 0


def test_proximity_finds_words_in_any_order(spark):
    words = "alpha beta gamma delta epsilon zeta eta theta iota kappa".split()
    docs = [(1, " ".join(reversed(words))), (2, " x ".join(words) + " y" * 50), (3, " ".join(words[:9]))]
    found = decontam.find_contamination(
        spark.createDataFrame(docs, SCHEMA),
        spark.createDataFrame([(8, " ".join(words))], "item_id long, text string"),
    )
    assert {r.id: (r.n_hit, r.near_items) for r in found.collect()} == {
        1: (0, ["8"]), 2: (0, ["8"]), 3: (0, []),
    }


# -- 6 and 8


def test_classifiers_on_held_out_rows(spark):
    folder = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    truth = labels.filter(samples.held_out(F.col("doc_id")))
    quality = co_training.score_quality(docs, co_training.fit_on(docs, labels))
    toxic = toxic_crf.score_toxicity(docs, toxic_crf.fit_on(docs, labels))
    for scored, label, least in ((quality, "quality", 0.97), (toxic, "toxic", 0.9)):
        assert scored.count() == docs.count()
        right = scored.join(truth, scored["id"] == truth["doc_id"])
        right = right.select(((F.col("score") >= 0.5).cast("int") == F.col(label)).cast("int").alias("ok"))
        assert right.agg(F.avg("ok")).first()[0] >= least


def test_co_training_exchanges_labels_over_all_unlabelled_rows(spark, monkeypatch):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    known = {r.doc_id for r in labels.collect()}
    kept = {}
    train = co_training.train
    monkeypatch.setattr(co_training, "train", lambda *given: kept.update(model=train(*given), given=given) or kept["model"])
    # Without a name or with a repeated one, rows take part like all others.
    extra = docs.limit(40).withColumn("doc_id", F.lit(None).cast("long"))
    docs = docs.union(extra).union(extra)
    co_training.fit_on(docs, labels, confidence=0.8)
    labelled, y, calibrate, _ = kept["given"]
    rows = [r for r in docs.collect() if r.doc_id not in known]
    assert len(rows) > 80
    data, offsets = co_training.tb.column_bytes(co_training.pa.array([r.text or "" for r in rows]))
    free = (
        co_training.content_features(data, offsets).astype(np.float32).astype(float),
        co_training.metadata_features(
            *(co_training.pa.array([r[c] for r in rows]) for c in co_training.METADATA)
        ).astype(np.float32).astype(float),
    )
    # The same steps with all rows in one place, each sure row as a row of its own.
    views = [co_training.logistic.fit(x[~calibrate], y[~calibrate]) for x in labelled]
    for _ in range(co_training.ROUNDS):
        told = [co_training.logistic.sigmoid(co_training.logistic.logits(free[v], views[v])) for v in (0, 1)]
        learned = []
        for v in (0, 1):
            p = told[1 - v]
            sure = (p >= 0.8) | (p <= 0.2)
            assert sure.any()
            n = (~calibrate).sum()
            weight = np.r_[np.ones(n), np.full(sure.sum(), min(0.3, 0.5 * n / sure.sum()))]
            x = np.r_[labelled[v][~calibrate], free[v][sure]]
            learned.append(co_training.logistic.fit(x, np.r_[y[~calibrate], p[sure].round()], weight))
        views = learned
    for v in (0, 1):
        assert np.abs(views[v] - kept["model"].views[v]).max() < 0.1
        own, all_in_one = (co_training.logistic.sigmoid(co_training.logistic.logits(free[v], b)) for b in (kept["model"].views[v], views[v]))
        assert np.abs(own - all_in_one).max() < 0.02


def test_marginals_equal_sums_over_all_taggings():
    rng = np.random.default_rng(8)
    lengths = [1, 6, 3, 1, 9, 2]
    total = sum(lengths)
    begins = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    features = rng.integers(0, 16, (3, total))
    model = toxic_crf.Model(rng.normal(0, 1.5, (3, 16)), -0.4, rng.normal(0, 1.5, (2, 2)), np.zeros(3))
    at = np.arange(total)
    toks = toxic_crf.Tokens(np.zeros(total, int), at, at + 1, at, features, begins)
    wanted = []
    for begin, length in zip(begins, lengths):
        score = [model.bias + sum(model.weights[k][features[k, begin + t]] for k in range(3)) for t in range(length)]
        mass, ones = 0.0, np.zeros(length)
        for tags in itertools.product((0, 1), repeat=length):
            moves = sum(model.moves[a, b] for a, b in zip(tags, tags[1:]))
            weight = np.exp(np.dot(tags, score) + moves)
            mass, ones = mass + weight, ones + weight * np.array(tags)
        wanted.extend(ones / mass)
    assert np.allclose(toxic_crf.marginals(model, toks), wanted, atol=1e-9)


def test_classifiers_on_odd_rows(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long, score string"
    rows = [(1, None, None, None, None, "x"), (None, "", "en", "s", 0, "x"), (2, "word " * 20_000, "en", "s", 9, "x")] * 2
    docs = spark.createDataFrame(rows, schema)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    some = spark.createDataFrame([(1, 1, 1), (2, 0, 0), (2, 1, 0), (None, 1, 1)], none.schema)
    for labels in (none, some):
        quality = co_training.score_quality(docs, co_training.fit_on(docs, labels)).collect()
        toxic = toxic_crf.score_toxicity(docs, toxic_crf.fit_on(docs, labels)).collect()
        assert len(quality) == len(toxic) == len(rows)
        assert all(0 <= r.score <= 1 for r in quality + toxic)
    assert toxic_crf.score_toxicity(docs.limit(0), toxic_crf.fit_on(docs, none)).count() == 0


# -- 7


def test_perfect_hash_is_minimal_and_knows_its_keys():
    keys = np.unique(np.random.default_rng(1).integers(0, 2**63, 3000)).astype(np.uint64)
    for n in (0, 1, 2, 3, 17, len(keys)):
        made = perfect_hash.build(keys[:n])
        assert sorted(made.slots(keys[:n]).tolist()) == list(range(n))
        assert (made.slots(keys[:n] + np.uint64(1)) >= 0).sum() <= 1


def test_token_files_round_trip(spark):
    rnd = random.Random(1)
    texts = ["".join(rnd.choice(ODD_TEXTS) for _ in range(rnd.randint(0, 40))) for _ in range(400)]
    rows = [(i * 13 % 997, t) for i, t in enumerate(texts)]
    rows += [(None, "x y"), (None, None), (5, None), (5, "zz"), (2000, "word " * 50_000)]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("start", F.lit(1))
    folder = Scratch(spark, "tokens-test").path("files")
    token_files.write_tokens(df, folder, TOKENIZER, shard_number=3)
    library = token_files.piece_tokenizer(TOKENIZER)._library
    wanted, start = [], 0
    for ident, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = [*library.encode(text or "", add_special_tokens=False).ids, 0]
        raw = np.array(ids, "<u4").tobytes()
        wanted.append((ident, start, len(ids), zlib.crc32(raw), raw))
        start += len(ids)
    found = token_files.read_tokens(spark, folder, df).collect()
    got = [(r.doc_id, r.start, r.n_tokens, r.ids_crc32, bytes(r.ids)) for r in found]
    assert sorted(got, key=lambda r: r[1]) == wanted
    few = spark.createDataFrame([(5,), (5,), (10**12,)], "doc_id long")
    assert token_files.read_tokens(spark, folder, few).count() == sum(r[0] == 5 for r in rows)
    folder = Scratch(spark, "tokens-test").path("none")
    token_files.write_tokens(df.limit(0), folder, TOKENIZER)
    assert token_files.read_tokens(spark, folder, df).count() == 0


def test_token_files_give_added_tokens_their_ids(spark):
    library = Tokenizer.from_file(TOKENIZER)
    rnd = random.Random(7)
    parts = [*"a .<|>", "<|endoftext|>", "<|endof", "text|>", " word", "\n", "é", "\r"]
    rows = [(i, "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 12)))) for i in range(800)]
    rows += [(800, "a <|endoftext|> b"), (801, "end <|endof"), (802, "text|> begin")]
    data, offsets = [t.encode() for _, t in rows], np.cumsum([0] + [len(t.encode()) for _, t in rows])
    flat = np.frombuffer(b"".join(data), np.uint8)
    ids, counts = token_files.PieceTokenizer(TOKENIZER).encode(flat, offsets)
    wanted = [library.encode(t, add_special_tokens=False).ids for _, t in rows]
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == wanted
    assert [64, 220, 50256, 275] in wanted
    folder = Scratch(spark, "tokens-test").path("added")
    df = spark.createDataFrame(rows, SCHEMA)
    token_files.write_tokens(df, folder, TOKENIZER, shard_number=2)
    found = token_files.read_tokens(spark, folder, df).collect()
    assert {r.doc_id: np.frombuffer(r.ids, "<u4").tolist() for r in found} == {
        i: [*own, token_files.END_ID] for (i, _), own in zip(rows, wanted)
    }


def test_pieces_of_several_texts_make_no_added_token(tmp_path):
    library = Tokenizer.from_file(TOKENIZER)
    library.add_special_tokens([" so it is"])
    library.save(str(tmp_path / "own.json"))
    texts = [" so", "x it", "x is", "x so it is"]
    raw = [t.encode() for t in texts]
    flat = np.frombuffer(b"".join(raw), np.uint8)
    own = token_files.PieceTokenizer(str(tmp_path / "own.json"))
    ids, counts = own.encode(flat, np.cumsum([0] + [len(r) for r in raw]))
    wanted = [library.encode(t, add_special_tokens=False).ids for t in texts]
    assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == wanted


# -- 9


def plain_lookup_table(weights, size):
    """Whole preference lists, and turns taken one by one."""
    def number(name, salt, among):
        return int.from_bytes(blake2b(f"{salt}:{name}".encode(), digest_size=8).digest(), "big") % among

    wishes = {}
    for name in sorted(weights):
        first, skip = number(name, "offset", size), number(name, "skip", size - 1) + 1
        wishes[name] = [(first + i * skip) % size for i in range(size)]
        assert len(set(wishes[name])) == size
    owner = {}
    while len(owner) < size:
        for name in sorted(weights):
            for _ in range(weights[name]):
                left = [slot for slot in wishes[name] if slot not in owner]
                if left:
                    owner[left[0]] = name
    return [owner[slot] for slot in range(size)]


@pytest.mark.parametrize("weights", [{"a": 1}, {"b": 1, "a": 1, "c": 1}, {"x": 3, "y": 1, "z": 2}])
def test_maglev_equals_turns_over_whole_preference_lists(spark, weights):
    assert maglev.lookup_table(weights, 101) == plain_lookup_table(weights, 101)
    ids = [0, 1, -5, 2**62, None, 7, 7, *range(100, 160)]
    df = spark.createDataFrame([(i, "old") for i in ids], "doc_id long, shard string")
    got = [(r.doc_id, r.slot, r.shard) for r in maglev.place(df, weights, size=101).collect()]
    table, wanted = plain_lookup_table(weights, 101), []
    for i in ids:
        code = 42 if i is None else xxhash.xxh64(struct.pack("<q", i), 42).intdigest()
        code = xxhash.xxh64(struct.pack("<i", i is None), code).intdigest()
        slot = (code - (code >> 63 << 64)) % 101
        wanted.append((i, slot, table[slot]))
    assert by_text(got) == by_text(wanted)


def test_maglev_is_even_and_moves_few_keys(spark):
    shards = [f"s{i}" for i in range(7)]
    table = maglev.lookup_table(shards, 1009)
    sizes = [table.count(s) for s in shards]
    assert max(sizes) - min(sizes) <= 1
    fewer = maglev.lookup_table(shards[1:], 1009)
    moved = sum(a != b for a, b in zip(table, fewer) if a != "s0")
    assert moved < 0.1 * 1009
    weighted = maglev.lookup_table({"a": 3, "b": 1}, 1009)
    assert abs(weighted.count("a") / 1009 - 0.75) < 0.01
    with pytest.raises(ValueError):
        maglev.lookup_table(shards, 1000)
    df = spark.createDataFrame([(i % 90, "x") for i in range(200)] + [(None, None)], "doc_id long, slot string")
    placed = maglev.place(df, shards)
    assert placed.count() == 201 and placed.columns == ["doc_id", "slot", "shard"]
    assert placed.select("doc_id", "shard").distinct().count() == 91
    names = dict(enumerate(maglev.lookup_table(shards)))
    assert all(names[r.slot] == r.shard for r in placed.collect())
    assert maglev.place(df.limit(0), shards).count() == 0


# -- 10


def near_docs():
    rnd = random.Random(5)
    words, docs = [f"w{i}" for i in range(300)], []
    for _ in range(10):
        base = [rnd.choice(words) for _ in range(rnd.choice([2, 3, 5, 10, 40, 200]))]
        for _ in range(rnd.randint(1, 10)):
            text = list(base)
            for _ in range(rnd.randint(0, max(1, len(text) // 25))):
                text[rnd.randrange(len(text))] = rnd.choice(words)
            docs.append((len(docs) * 7 % 1009, " ".join(text)))
    return docs + [
        (2000, None), (2001, " \t"), (2002, "one"), (2003, "One\n"), (None, "one"), (None, "zz zy"),
        (None, None), docs[0], (3000, "same " * 5000), (3001, "same " * 5000),
    ]


@pytest.mark.parametrize("size", [2, 5])
def test_near_duplicates_equal_brute_force(spark, size):
    docs = near_docs()
    df = spark.createDataFrame(docs, SCHEMA).withColumn("component_id", F.lit("x"))
    found = near_dup.near_duplicates(df, shingle=size).collect()
    got = [(r.id, r.n_shingles, r.component_id) for r in found]
    assert by_text(got) == by_text(brute.near_duplicates(docs, size))
    assert all(r.kept == (r.component_id is None or r.id == r.component_id) for r in found)


def null_id_groups():
    """Near copies whose rows have no id, or share one; each list is a group."""

    def near(name, *changed):
        return " ".join(f"{name}{'x' if i in changed else ''}{i}" for i in range(60))

    return [
        [(10, near("a")), (None, near("a", 59)), (None, near("a", 58, 59)), (None, near("a", 59))],
        [(None, near("b")), (None, near("b", 59)), (None, near("b", 0))],
        # The first and the last are apart but for the text between them.
        [(21, near("c")), (None, near("c", 0, 1, 2)), (20, near("c", 0, 1, 2, 57, 58, 59))],
        [(30, near("d")), (31, near("d", 59))],
        [(30, near("e")), (30, near("e", 59)), (None, near("e", 0))],
        [(None, near("f"))],
    ]


def test_rows_without_id_link_like_all_others(spark):
    groups = null_id_groups()
    docs = [d for g in groups for d in g]
    df = spark.createDataFrame(docs, SCHEMA).repartition(5)
    found = near_dup.near_duplicates(df).collect()
    got = [(r.id, r.n_shingles, r.component_id) for r in found]
    assert by_text(got) == by_text(brute.near_duplicates(docs, 5))
    kept = [r.id for r in found if r.kept]
    assert by_text(kept) == by_text([10, None, 20, 30, 30, 30, None])
    assert all(r.kept == (r.id == r.component_id) for r in found if r.component_id is not None)
    made = near_dup.leading_rows(df.withColumn("own", F.lit("x")))
    assert made.columns == ["doc_id", "text", "own"]
    rows = [(r.doc_id, r.text) for r in made.collect()]
    assert len(rows) == len(groups) and [sum(r in g for r in rows) for g in groups] == [1] * len(groups)
    assert by_text(r[0] for r in rows) == by_text([10, None, 20, 30, 30, None])


def test_no_shingle_meets_every_band_early():
    band = np.full(near_dup.SLOTS, -1)
    band[near_dup.DEALT] = np.repeat(np.arange(near_dup.BANDS), near_dup.BAND_ROWS)
    assert np.array_equal(np.bincount(band[band >= 0]), [near_dup.BAND_ROWS] * near_dup.BANDS)
    # One of five shingles takes about a fifth of all slots; its visits are start + rank * stride.
    start, stride, rank = np.ogrid[: near_dup.SLOTS, 1 : near_dup.SLOTS, : near_dup.SLOTS // 5]
    met = np.sort(band[(start + rank * stride) % near_dup.SLOTS], axis=-1)
    assert ((np.diff(met, axis=-1) > 0).sum(-1) + (met[..., 0] >= 0)).max() < near_dup.BANDS


def test_near_duplicates_of_nothing(spark):
    assert near_dup.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0


def test_rarest_shingles_find_all_similar_pairs(spark):
    rng = random.Random(3)
    base = [f"w{i}" for i in range(60)]
    texts = {}
    for i in range(80):
        words = base[: rng.choice([3, 6, 20, 60])]
        for _ in range(rng.randrange(1, 4)):
            words[rng.randrange(len(words))] = f"v{rng.randrange(40)}"
        texts[i] = " ".join(words)
    sets = {i: set(zip(t.split(), t.split()[1:], strict=False)) for i, t in texts.items()}
    want = {
        (i, j)
        for i in sets
        for j in sets
        if i < j and 10 * len(sets[i] & sets[j]) >= 8 * len(sets[i] | sets[j])
    }
    assert want
    rows = spark.createDataFrame(list(texts.items()), "id long, text string")
    mixed = rows.selectExpr("1L as bucket", "id as node", "id as component")
    scratch = Scratch(spark, "test")
    matcher = near_dup._Matcher(rows, None, 2, 80, scratch)
    got = {tuple(r) for r in near_dup._across(mixed, matcher).distinct().collect()}
    scratch.drop()
    assert want <= got and len(got) < len(sets) * (len(sets) - 1) // 4


def test_checked_encoding_equals_encode_and_decode(spark):
    texts = [None, "", "a", "Straße 東京 \n" * 9000, "x" * 5000, "two  words"]
    docs = spark.createDataFrame(
        [(i, t, "e") for i, t in enumerate(texts)], "doc_id long, text string, ids string"
    ).repartition(1)
    ranks = P.path("byte_bpe_50k.tiktoken")
    want = bpe.encode(docs, ranks, P.PATTERN).select("row.doc_id", "n_tokens", "ids").collect()
    got = bpe.encode_checked(docs, ranks, P.PATTERN).collect()
    assert {r.doc_id: (r.n_tokens, r.ids) for r in want} == {
        r.row.doc_id: (r.n_tokens, r.ids) for r in got
    }
    assert [r.text for r in sorted(got, key=lambda r: r.row.doc_id)] == texts
    assert all(r.round_trip and r.row.ids == "e" for r in got)
