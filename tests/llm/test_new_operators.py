"""Conversation repair, phrase collocations and nearest neighbours, against plain versions."""

from __future__ import annotations

import itertools
import math
import random
import re
from collections import Counter
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tradelake.llm import collocations, conversation_repair, cross_polytope, queries
from tradelake.llm import textbytes as tb
from tradelake.llm.count_automata import CountAutomaton, summed
from tradelake.llm.role_grammar import Repairer, Tables, roles_by_audit, turn_kind
from tradelake.llm.scratch import Scratch

WHITE = " \t\n\x0b\x0c\r"
TALK = "conv_id long, turn long, role string, text string"


def thue_morse(size):
    letters = b"a"
    while len(letters) < size:
        letters += bytes(195 - c for c in letters)
    return letters


# -- words


def test_long_words_of_equal_sums_have_different_hashes():
    one = thue_morse(1024)
    two = bytes(195 - c for c in one)
    data = np.frombuffer(one + b" " + two + b" " + one, np.uint8)
    begin = np.array([0, 1025, 2050])
    hashes = tb.hash_spans(data, begin, begin + 1024)
    assert hashes[0] != hashes[1] and hashes[0] == hashes[2]


def test_hashes_do_not_depend_on_place():
    words = [b"a", b"bb", b"x" * 70_000, b"y" * 3000, b"bb", b"x" * 70_000, b""]
    data = np.frombuffer(b" ".join(words * 30), np.uint8)
    begin, end = tb.blank_words(data, np.array([0, len(data)]))
    hashes = tb.hash_spans(data, begin, end).tolist()
    texts = [data[b:e].tobytes() for b, e in zip(begin, end)]
    assert len(set(hashes)) == len(set(texts)) == len(set(zip(hashes, texts))) == 4
    assert len(tb.hash_spans(data, begin[:0], end[:0])) == 0


def test_decontamination_tells_long_words_apart(spark):
    from tradelake.llm import decontam, near_dup

    one = thue_morse(1024).decode()
    two = "".join(chr(195 - ord(c)) for c in one)
    rest = " ".join(f"w{i}" for i in range(9))
    docs = spark.createDataFrame([(1, f"{two} {rest}"), (2, f"{one} {rest}")], "doc_id long, text string")
    items = spark.createDataFrame([("i", f"{one} {rest}")], "item_id string, text string")
    found = {r.id: r.n_hit for r in decontam.find_contamination(docs, items).collect()}
    assert found == {1: 0, 2: 10}
    short = spark.createDataFrame([(1, f"{one} x"), (2, f"{two} x")], "doc_id long, text string")
    assert {r.component_id for r in near_dup.near_duplicates(short, shingle=2).collect()} == {1, 2}


# -- 11


def cheapest(turns):
    """Least (cost, audit) over all edits; turns are (initial, must go, truncated)."""
    legal, best = re.compile(r"(s?(ua)+)?\Z"), None
    inserts = ["", "u", "a", "ua", "au"]
    for edits in itertools.product("KuaD", repeat=len(turns)):
        if any(e != "D" and t[1] or e == "K" and t[0] not in ("s", "u", "a") for e, t in zip(edits, turns)):
            continue
        for gaps in itertools.product(inserts, repeat=len(turns) + 1):
            roles, audit, cost = gaps[0], "I" * len(gaps[0]), 5 * sum(map(len, gaps))
            for (initial, _, cut), edit, gap in zip(turns, edits, gaps[1:]):
                cost += 2 if edit == "D" else 5 * cut + (edit != "K")
                roles += {"K": initial, "D": ""}.get(edit, edit) + gap
                audit += {"K": "K", "D": "D"}.get(edit, "R") + "I" * len(gap)
            if legal.match(roles):
                best = min(best or (cost, audit), (cost, audit))
    return best


def test_parser_finds_the_cheapest_edits():
    repairer, rnd = Repairer(), random.Random(1)
    start = repairer.entries()[0]
    for n in (0, 1, 2, 3):
        for _ in range(25):
            turns = [(rnd.choice("suaxS"), rnd.random() < 0.2, rnd.random() < 0.3) for _ in range(n)]
            kinds = "".join(turn_kind(*t) for t in turns)
            assert repairer.ended(repairer.follow(start, kinds, True))[:2] == cheapest(turns)


def test_blocks_put_together_equal_one_block():
    repairer, rnd = Repairer(), random.Random(2)
    entries = repairer.entries()
    for _ in range(40):
        kinds = "".join(
            turn_kind(rnd.choice("suax"), rnd.random() < 0.2, rnd.random() < 0.2) for _ in range(rnd.randint(1, 30))
        )
        whole = repairer.ended(repairer.follow(entries[0], kinds, True))
        cut = sorted(rnd.sample(range(len(kinds) + 1), 2))
        parts = [kinds[: cut[0]], kinds[cut[0] : cut[1]], kinds[cut[1] :]]
        talk = conversation_repair._Conversation(0, repairer, entries)
        for i, part in enumerate(parts):
            asked = [(-1, entries[0])] if i == 0 else list(enumerate(entries))
            ways = [
                {"entry": e, "cost": c, "audit": a, "exit": entries.index(s)}
                for e, stack in asked
                for c, a, s in repairer.follow(stack, part, i == 0)
            ]
            counts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
            talk.add({"ways": ways, "seg": i, "first": None, "low": None, **counts})
        *_, last = talk.rows()
        assert (last["summary"]["cost"], last["summary"]["audit"]) == whole[:2]


def test_grammars_that_blocks_cannot_be_cut_by_are_refused():
    with pytest.raises(ValueError, match="bounded"):
        Tables({"x": (("u", "x", "a"), ("u", "a"))}, "x")


def test_roles_of_edits():
    assert roles_by_audit("IKDRI", ["a", "x", "s"], "") == [("I", -1, "u"), ("K", 0, "a"), ("R", 2, "u"), ("I", -1, "a")]
    assert roles_by_audit("K", ["u"], "a") == [("K", 0, "u")]


def repaired_plainly(rows):
    """conv_id -> (gaps, blank, duplicate, truncated, illegal, cost, audit, sha256) by the whole conversation."""
    repairer, out = Repairer(), {}
    talks = {}
    for conv, turn, role, text, *_ in rows:
        talks.setdefault(conv, []).append((turn, " " if role is None else role, " " if text is None else text))
    for conv, turns in talks.items():
        turns.sort(key=lambda t: (t[0] is not None, t[0] or 0, t[1], t[2]))
        seen, faults = set(), []
        for _, role, text in turns:
            end = text.rstrip(WHITE)
            again, cut = (role, text) in seen, not end.endswith((".", "!", "?"))
            faults.append("blank" if not end else "duplicate" if again else "truncated" if cut else "")
            seen.add((role, text))
        initials = [t[1][:1] for t in turns]
        kinds = "".join(
            turn_kind(r, f in ("blank", "duplicate"), f == "truncated") for r, f in zip(initials, faults)
        )
        cost, audit, _ = repairer.ended(repairer.follow(repairer.entries()[0], kinds, True))
        known = [t[0] for t in turns if t[0] is not None]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        made = {"u": "user", "a": "assistant"}
        lines = [
            f"{turns[i][1] if e == 'K' else made[r]}:{turns[i][2] if i >= 0 else ''}"
            for e, i, r in roles_by_audit(audit, initials, "")
        ]
        illegal = sum(x + y not in ("su", "ua", "au") for x, y in zip(initials, initials[1:]))
        digest = sha256("\n".join(lines).encode()).hexdigest()
        out[conv] = (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest)
    return out


def repaired_by_spark(df, **options):
    repaired = conversation_repair.repair_conversations(df, **options)
    rows = repaired.summary.join(conversation_repair.text_digests(repaired), "conversation").collect()
    names = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "sha256")
    assert len({r.conv for r in rows}) == len(rows)
    return {r.conv: tuple(r[n] for n in names) for r in rows}


def odd_talks():
    rnd, rows = random.Random(3), []
    texts = ["Hi.", "What?", "cut", "", " \t", None, "Hi.", "é…", "ok!\n", "x" * 50 + "."]
    roles = ["user", "assistant", "system", "tool", None, "", "User"]
    weights = [8, 8, 2, 1, 1, 1, 1]
    for conv in [*range(25), None]:
        for _ in range(rnd.randint(1, 12)):
            turn = rnd.choice([None, *range(10)])
            rows.append((conv, turn, rnd.choices(roles, weights)[0], rnd.choice(texts)))
    rows += [(7, 3, "user", "Hi.")] * 3
    # One conversation has a third of all turns.
    rows += [(99, i, ("user", "assistant")[i % 2 ^ (i % 37 == 0)], f"t{i % 40}" + ("." if i % 11 else "")) for i in range(150)]
    return rows


@pytest.mark.parametrize("turns", [1024, 4])
def test_repair_equals_a_plain_version(spark, monkeypatch, turns):
    monkeypatch.setattr(conversation_repair, "BLOCK_TURNS", turns)
    rows = odd_talks()
    df = spark.createDataFrame(rows, TALK).repartition(3).withColumns({"seg": F.lit("x"), "conversation": F.lit(1)})
    assert repaired_by_spark(df) == repaired_plainly(rows)


def test_repair_of_conversations_without_turns(spark):
    rows = [(1, 0, "user", "Hi.", False), (2, 0, "user", "Hi.", True), (2, 1, "user", "x.", False), (3, 1, "a", None, None)]
    df = spark.createDataFrame(rows, f"{TALK}, here boolean")
    none = (0, 0, 0, 0, 0, 0, "", sha256(b"").hexdigest())
    found = repaired_by_spark(df, present=F.col("here"))
    assert found[1] == found[3] == none and found[2][6] == "D"
    assert repaired_by_spark(df.limit(0), present=F.col("here")) == {}
    left = conversation_repair.repair_conversations(df.drop("here").filter("conv_id = 2")).blocks
    assert [t.text for r in left.collect() for t in r.left] == ["Hi.", "x."] or left.count() == 1


# -- 12


def test_automata_hold_their_sequences():
    rnd = np.random.default_rng(1)
    for depth, rows in itertools.product((1, 2, 4), (0, 1, 300)):
        columns = [rnd.integers(0, 12, rows).astype(np.uint64) << np.uint64(60) for _ in range(depth)]
        columns, weights = summed(columns, np.ones(rows, np.int64) * (1 << 40))
        one = CountAutomaton.from_bytes(CountAutomaton.build(columns, weights).to_bytes())
        back, counts = one.paths()
        assert all((x == y).all() for x, y in zip(columns, back)) and (counts == weights).all()
        assert (one.look_up(columns) == weights).all()
        assert not one.look_up([c + np.uint64(1) for c in columns]).any()
        total = CountAutomaton.union([one, one, one], limit=100)[1]
        assert (total == 3 * weights).all()
    # States with equal arcs are one: all 2^10 sequences of two labels take ten states.
    pairs = np.array(list(itertools.product((1, 2), repeat=10)), np.uint64)
    least = CountAutomaton.build([np.ascontiguousarray(c) for c in pairs.T], np.ones(1024, np.int64))
    assert [len(f) - 1 for f in least.first] == [1] * 10


def phrases_plainly(docs, least=30, top=2000):
    counts, totals = {}, Counter()
    lower = {c: c + 32 for c in range(65, 91)}
    for lang, text in docs:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\x0a-\x0d]", (text or "").translate(lower)):
            words = re.findall("[^ \t]+", piece)
            totals[lang] += len(words)
            for n in range(1, 5):
                for i in range(len(words) - n + 1):
                    gram = tuple(words[i : i + n])
                    counts.setdefault(lang, Counter())[gram] += 1
    out = []
    for lang, f in counts.items():
        known = {g: c for g, c in f.items() if c >= least and len(g) > 1}
        rows = []
        for gram, a in known.items():
            cuts = [(2000000 * a // (f[gram[:k]] + f[gram[k:]]), k) for k in range(1, len(gram))]
            score, k = min(cuts)
            inside = [
                c for g, c in known.items()
                if len(g) > len(gram) and any(g[i : i + len(gram)] == gram for i in range(len(g) - len(gram) + 1))
            ]
            if not any(100 * c >= 80 * a for c in inside):
                rows.append((-score, -a, " ".join(gram).encode(), f[gram[:k]], f[gram[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def mined(df, **options):
    return sorted(tuple(r) for r in collocations.mine_phrases(df, **options).collect())


def phrase_docs():
    rnd = random.Random(4)
    words = ["the", "The", "of", "new", "york", "city", "é", "ß x", "a", "\x00", "漢字", "w" * 80_000]
    common = ["new york city hall", "of the", "york city. new york"]
    docs = []
    for i in range(160):
        parts = [rnd.choice(common) if rnd.random() < 0.4 else rnd.choice(words[:-1]) for _ in range(30)]
        text = "".join(p + rnd.choice([" ", " ", "\t", ", ", ".\n"]) for p in parts)
        docs.append((rnd.choice(["en", "en", "de", None, "und"]), text))
    docs += [("en", "z z z z z z z z " * 9), ("en", None), (None, ""), ("fr", "only once"), ("en", words[-1] + " of the")]
    return docs + docs[:20]


@pytest.mark.parametrize("small", [False, True])
def test_phrases_equal_a_plain_version(spark, monkeypatch, small):
    if small:
        # Tiny buffers and pieces, set in the tasks: the same result by many more automata.
        def tiny(step):
            def run(*args, **options):
                before = collocations.BUFFER_WORDS, collocations.words_of.__defaults__
                collocations.BUFFER_WORDS, collocations.words_of.__defaults__ = 200, (64,)
                try:
                    yield from step(*args, **options)
                finally:
                    collocations.BUFFER_WORDS, collocations.words_of.__defaults__ = before

            return run

        for name in ("_count_words", "_count_ngrams"):
            monkeypatch.setattr(collocations, name, tiny(getattr(collocations, name)))
    docs = phrase_docs()
    df = spark.createDataFrame(docs, "lang string, text string").repartition(3).withColumn("label", F.lit(1))
    assert mined(df, least=10, top=15) == phrases_plainly(docs, 10, 15)


def test_phrases_of_nothing(spark):
    df = spark.createDataFrame([(None, None), ("en", " . ")], "lang string, text string")
    assert mined(df) == mined(df.limit(0)) == []


def test_texts_are_cut_between_pieces_only():
    text = "ab cd. " * 20 + "x" * 300 + " y, z"
    batch = pa.RecordBatch.from_pydict({"text": [text, None, "", "q r.s"], "lang": ["en"] * 4})
    whole = next(iter(collocations.words_of(batch, 0, 1 << 20)))
    parts = list(collocations.words_of(batch, 0, 16))
    assert len(parts) > 10
    assert np.concatenate([p.labels for p in parts]).tolist() == whole.labels.tolist()
    assert np.concatenate([p.joined for p in parts]).tolist() == whole.joined.tolist()
    assert np.concatenate([p.rows for p in parts]).tolist() == whole.rows.tolist()


def test_filter_lets_all_frequent_ones_through(spark):
    rows = spark.range(2000).selectExpr("xxhash64(id) AS label")
    known = collocations._filter(rows, collocations._labels_of, 20).value.open()
    labels = np.array([r.label for r in rows.collect()], np.int64).view(np.uint64)
    assert known.test(labels).all()
    assert known.test(tb.mix(np.arange(20_000, dtype=np.uint64))).mean() < 0.01


def test_labels_that_collide_get_another_seed(spark, monkeypatch):
    docs = spark.createDataFrame([("en", "a b c")], "lang string, text string")
    real = collocations._count_words

    def count(batches, seed):
        for batch in real(batches, seed):
            labels = batch.column("label") if seed else pa.array([7] * batch.num_rows, pa.int64())
            yield batch.set_column(0, "label", labels)

    monkeypatch.setattr(collocations, "_count_words", count)
    words, seed = collocations._vocabulary(docs, Scratch(spark, "words"))
    assert seed == 1 and sorted(bytes(r.word) for r in words.collect()) == [b"a", b"b", b"c"]


# -- 13


def nearest_plainly(rows, ask, k=10):
    rows = [
        (i, n, np.array(v, float)) for n, (i, v) in enumerate(rows)
        if i is not None and v is not None and None not in v and len(v) == 4 and np.isfinite(v).all() and any(v)
    ]
    out = []
    for i, n, q in rows:
        if ask(i):
            apart = sorted((math.dist(v, q), j) for j, m, v in rows if m != n)
            out += [(i, r, j, d) for r, (d, j) in enumerate(apart[:k], 1)]
    return sorted(out, key=str)


def test_neighbours_on_odd_vectors(spark):
    rnd = random.Random(5)
    rows = [(i, [rnd.gauss(0, 1) for _ in range(4)]) for i in range(60)]
    rows += [(100 + i, [1.0, 2.0, 3.0, 4.0]) for i in range(30)] + [(5, rows[5][1]), (5, rows[5][1])]
    rows += [(200, None), (210, [0.0] * 4), (220, [1.0, None, 1.0, 1.0]), (230, [float("nan")] * 4), (240, [1.0, 2.0])]
    rows += [(250, [float("inf"), 1.0, 1.0, 1.0]), (None, [1.0] * 4), (260, []), (270, [1e200, -1e200, 1.0, 0.0])]
    rows += [(280, [1e-300, 0.0, 0.0, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("row", F.lit(1))
    # All buckets are probed where the share asked for is the whole.
    found = cross_polytope.nearest_neighbours(df, F.col("vec_id") % 10 == 0, recall=1.0, tables=3)
    got = sorted(((r.query_id, r["rank"], r.vec_id, r.score) for r in found.collect()), key=str)
    wanted = nearest_plainly(rows, lambda i: i % 10 == 0)
    assert [g[:3] for g in got] == [w[:3] for w in wanted]
    assert np.allclose([g[3] for g in got], [w[3] for w in wanted], rtol=1e-12, atol=0)
    copies = [g for g in got if g[0] == 100]
    assert [(g[2], g[3]) for g in sorted(copies, key=lambda g: g[1])] == [(101 + i, 0.0) for i in range(10)]


def test_few_vectors_and_none(spark):
    schema = "vec_id long, embedding array<float>"
    few = spark.createDataFrame([(0, [1.0, 0.0, 0.0]), (7, [-1.0, 0.0, 0.5]), (9, [0.0, -1.0, 3.0])], schema)
    found = cross_polytope.nearest_neighbours(few, F.col("vec_id") == 0).orderBy("rank").collect()
    assert [(r.query_id, r["rank"], r.vec_id) for r in found] == [(0, 1, 7), (0, 2, 9)]
    assert cross_polytope.nearest_neighbours(few.filter("vec_id = 0"), F.lit(True)).count() == 0
    assert cross_polytope.nearest_neighbours(few, F.lit(False)).count() == 0
    assert cross_polytope.nearest_neighbours(few.limit(0), F.lit(True)).count() == 0


@pytest.mark.parametrize("hashes,block", [(1, 64), (2, 4096)])
def test_recall_against_brute_force(spark, sf, monkeypatch, hashes, block):
    monkeypatch.setattr(cross_polytope, "BLOCK_VECTORS", block)
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = df.select("vec_id", "embedding").collect()
    ids, vectors = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    found = cross_polytope.nearest_neighbours(df, F.col("vec_id") % 100 == 0, hashes=hashes).collect()
    hits = 0
    asked = ids[ids % 100 == 0]
    for q in asked:
        apart = cross_polytope.distances(np.ascontiguousarray(vectors.T), vectors[ids == q][0])
        apart[ids == q] = np.inf
        best = set(ids[np.lexsort([ids, apart])[:10]].tolist())
        own = sorted((r["rank"], r.vec_id, r.score) for r in found if r.query_id == q)
        assert [r for r, *_ in own] == list(range(1, 11))
        assert [s for *_, s in own] == sorted(apart[ids == v][0] for _, v, _ in own)
        hits += len(best & {v for _, v, _ in own})
    assert hits >= 0.9 * 10 * len(asked)


def test_rotations_keep_lengths():
    index = cross_polytope.make_index(5, 2, 2)
    rows = np.random.default_rng(0).normal(size=(50, 5))
    near = cross_polytope.turned(rows, index, 1)
    assert near.shape == (50, 2, 16)
    assert np.allclose((near[:, :, :8] ** 2).sum(axis=2), 1) and np.allclose(near[:, :, :8], -near[:, :, 8:])
    best = cross_polytope.closeness(rows, index, 0).argmax(axis=1)
    assert (best == cross_polytope.own_buckets(rows, index, 0)).all()


# -- against SQL


@pytest.mark.parametrize("name", ["op11_conversation_repair", "op12_collocations"])
def test_queries_equal_sql(spark, sf, name):
    from oracle import connect, difference

    result = queries.QUERIES[name](spark, sf)
    assert difference(result, connect(sf), queries.ORACLES[name]) is None
