"""Filtering, packing and classifying operators."""

from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lumenfold.llm.decontaminate import decontaminate, find_contamination, n_hit
from lumenfold.llm.langid import Classifier, identify_language, learn_dictionaries
from lumenfold.llm.packing import WordEncoder, pack, plan
from lumenfold.llm.quality import quality_verdicts
from lumenfold.llm.queries import queries
from lumenfold.llm.toxicity import FEATURES, Grammar, clause_machine, fit, match_clauses, matching, negation, reported_speech, training_sample
from lumenfold.llm.url_filter import BoostedTrees, Rules, fit_url_model, judge_urls, split_url

SCHEMA = "doc_id long, text string, lang string, source string, _text string, n_words int"
PATH = public_tokenizers.path("word_bpe_49k.json")


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "en", "s", "x", 1) for d, t in rows], SCHEMA)


def items(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


@pytest.mark.parametrize("block", [1 << 24, 60])
def test_decontamination(spark, block):
    bench = items(spark, [(1, "The quick, brown fox jumps over the lazy dog again and again"), (10, "Short item here"), (2, None), (3, "...")])
    rows = [
        (1, "before THE QUICK BROWN FOX JUMPS OVER THE LAZY DOG AGAIN after"),
        (2, "a short item here and short item here"),
        (3, "quick brown fox"),
        (4, None),
        (5, ""),
        (5, ""),
    ]
    docs = frame(spark, rows)
    found = find_contamination(docs, bench, 10, block_bytes=block).select("doc_id", "n_words", n_hit().alias("h"), "items").collect()
    got = Counter((r.doc_id, r.n_words, r.h, tuple(r["items"])) for r in found)
    assert got == Counter([(1, 12, 10, ("1",)), (2, 8, 6, ("10",)), (3, 3, 0, ()), (4, 0, 0, ()), (5, 0, 0, ()), (5, 0, 0, ())])
    kept = decontaminate(docs, bench, block_bytes=block)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [3, 4, 5, 5]
    cut = {r.doc_id: r.text for r in decontaminate(docs, bench, remove="spans", block_bytes=block).collect()}
    assert cut == {1: "before  after", 2: "a  and ", 3: "quick brown fox", 4: None, 5: ""}
    assert find_contamination(docs, items(spark, []), 10).where(F.size("hits") > 0).isEmpty()


def test_word_encoder_equals_whole_texts():
    rng = random.Random(1)
    alphabet = ["a", "b", "É", "ß", "Σ", "'", "'s", "’", ".", ",", "-", "_", " ", "\n", "\t", "\x1c", "\x85", "1", "½", "語", "e\u0301", "\u0301", "<|endoftext|>", "THE", "don't", "<|"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 40))) for _ in range(3000)]
    whole = [x.ids for x in Tokenizer.from_file(PATH).encode_batch(texts, add_special_tokens=False)]
    assert [list(map(int, x)) for x in WordEncoder(PATH).encode([t.encode() for t in texts])] == whole


def test_packing_round_trip(spark):
    rng = random.Random(2)
    rows = [(d, " ".join(f"word{rng.randrange(99)}" for _ in range(rng.choice([0, 3, 30, 400])))) for d in range(60)] + [(60, None), (61, ""), (5, "again"), (5, "again")]
    found = pack(frame(spark, rows), PATH, capacity=256, with_ids=True, block_rows=7).collect()
    coder = Tokenizer.from_file(PATH)
    want = Counter((d, tuple([*coder.encode(t or "", add_special_tokens=False).ids, 0])) for d, t in rows)
    whole, places = Counter(), {}
    pieces = {}
    for r in found:
        ids = np.array(r.ids, dtype="<u4")
        assert r.length == len(ids) <= 256 and r.ids_crc32 == zlib.crc32(ids.tobytes()) and r.start == 256 * r.piece
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
        pieces.setdefault(r.doc_id, Counter())[(r.piece, tuple(r.ids))] += 1
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= 256
    for d, own in pieces.items():
        if d != 5:
            whole[d, tuple(x for _, ids in sorted(own) for x in ids)] += 1
    assert whole == Counter({k: n for k, n in want.items() if k[0] != 5})
    assert sum(n for k, n in want.items() if k[0] == 5) == sum(pieces[5].values())
    total = sum(r.length for r in found)
    assert 9 * len(places) <= 11 * -(-total // 256)  # no worse than first-fit decreasing is sure to be


def test_plan_uses_each_length_as_often_as_it_is_there():
    rng = np.random.default_rng(3)
    for _ in range(20):
        counts = rng.integers(0, 9, 101)
        counts[0] = 0
        used = np.zeros(101, dtype=int)
        for times, chosen in plan(counts, 100):
            assert sum(chosen) <= 100
            for x in chosen:
                used[x] += times
        assert (used == counts).all()
    assert plan(np.zeros(101, dtype=int), 100) == []


def test_grammar_constructions():
    grammar = Grammar()
    read = lambda t: dict(zip(FEATURES, grammar.matches(t), strict=True))
    assert read("You are an idiot.")["targeted"] == 1
    assert read("He is not an idiot.")["negated"] == 1
    assert read("She said they are idiots.")["reported"] == 1
    assert read('The word "scum" is old.')["reported"] == 1
    assert read("I will kill you.")["threat"] == 1
    assert read("What trash in here today.")["insult"] == 1
    assert not grammar.matches(None).any() and not grammar.matches("").any()
    assert grammar.score(grammar.matches("You idiot. You moron.")) > 0.5 > grammar.score(grammar.matches("not an idiot"))


def all_paths(machine, labels, state=0):
    """(weight, outputs) of every accepting path."""
    if not labels:
        return [(0.0, ())] if machine.final[state] else []
    return [(w + v, (out, *outs)) for to, out, w in machine.arcs[state].get(labels[0], ()) for v, outs in all_paths(machine, labels[1:], to)]


def test_best_paths_equal_enumeration():
    rng, machine = random.Random(9), clause_machine()
    for _ in range(150):
        labels = tuple(rng.choice(range(7)) for _ in range(rng.randint(0, 8)))
        weight, counts = machine.best(labels, len(FEATURES))
        paths = all_paths(machine, labels)
        most = max(w for w, _ in paths)
        assert abs(weight - most) < 1e-9
        assert counts in {tuple(outs.count(k) for k in range(len(FEATURES))) for w, outs in paths if abs(w - most) < 1e-9}


def test_composition_reads_what_the_first_writes():
    rng = random.Random(10)
    parts = (negation(), reported_speech(), matching())
    for _ in range(100):
        labels = tuple(rng.choice(range(7)) for _ in range(rng.randint(0, 6)))
        step = labels
        for part in parts[:2]:
            ((_, step),) = all_paths(part, step)  # these two are deterministic
        assert sorted(all_paths(clause_machine(), labels)) == sorted(all_paths(parts[2], step))


def test_toxicity_of_long_and_odd_texts(spark):
    grammar = Grammar()
    plain = "word " * 60_000
    assert list(grammar.matches(plain + "you idiot")) == [0, 1, 0, 0, 0]
    assert grammar.score(grammar.matches("you idiot. " * 3)) == grammar.score(grammar.matches("you idiot. " * 400))
    labels = spark.createDataFrame([(1, 0), (1, 1), (2, None), (None, 1), (3, 0)], "doc_id long, toxic int")
    docs = frame(spark, [(1, "a"), (2, "b"), (None, "c"), (3, "d"), (3, "d")])
    assert sorted(tuple(r) for r in training_sample(docs, labels).collect()) == [("a", 1), ("d", 0), ("d", 0)]


def test_toxicity_on_held_out_labels(spark):
    """No clean document is hit, and most toxic ones are found: one in five holds no term at all."""
    found = queries()["op5_toxicity"](spark, "/root/testdata/sf0.01").join(spark.read.parquet("/root/testdata/sf0.01/labels.parquet"), "doc_id")
    rows = found.select("toxic", "predicted").collect()
    toxic = [r.predicted for r in rows if r.toxic]
    assert sum(toxic) >= 0.55 * len(toxic) and not any(r.predicted for r in rows if r.toxic == 0)


def test_toxicity_learns(spark):
    rng = random.Random(5)
    word = lambda: f"w{'abcdefghij'[rng.randrange(10)]}{'klmnopqrst'[rng.randrange(10)]}"
    rows = [(" ".join([word() for _ in range(20)] + (["grumblefist"] if k % 4 == 0 else [])), int(k % 4 == 0)) for k in range(200)]
    grammar = fit(spark.createDataFrame(rows, "_text string, toxic int"))
    assert "grumblefist" in grammar.extra
    docs = frame(spark, [(1, "well grumblefist then"), (2, "well then"), (3, None), (4, ""), (2, "well then")])
    got = {r.doc_id: r.score for r in match_clauses(docs, grammar).collect()}
    assert got[1] >= 0.5 > max(got[2], got[3], got[4])
    assert match_clauses(frame(spark, []), fit(spark.createDataFrame([], "_text string, toxic int"))).count() == 0


def test_language_by_compression(spark):
    words = {"aa": "thing there other while that".split(), "bb": "nicht einung schaft keiten und".split()}
    rng = random.Random(6)
    make = lambda lang, n: " ".join(rng.choice(words[lang]) + rng.choice(words[lang]) for _ in range(n))
    rows = [(k, make(lang, 30), lang, "s", "x", 1) for k, lang in enumerate(["aa", "bb"] * 40)]
    dictionaries = learn_dictionaries(spark.createDataFrame([*rows, (900, None, "cc", "s", "x", 1), (901, "x", None, "s", "x", 1)], SCHEMA))
    assert sorted(dictionaries) == ["aa", "bb"]
    docs = frame(spark, [(1, make("aa", 25)), (2, make("bb", 25)), (3, None), (4, "123 !"), (5, ""), (1, make("aa", 25))])
    got = {r.doc_id: (r.best, r.score) for r in identify_language(docs, dictionaries).collect()}
    assert got[1][0] == "aa" and got[2][0] == "bb" and got[3] == got[4] == got[5] == ("und", 0.0)
    assert Classifier({}).classify("text") == ("und", 0.0, 0)


def test_rules_and_parts():
    rules = Rules({"com/": "allow", "example.com/en/": "block", "www.example.com/en/": "allow", "net/es/": "block"})
    cases = {
        "http://Example.COM/en/x?q#f": ("example.com", "/en/x", "example.com/en/"),
        "https://a.www.example.com/en/": ("a.www.example.com", "/en/", "www.example.com/en/"),
        "https://example.com": ("example.com", "", None),
        "x://notexample.com/en/": ("notexample.com", "/en/", "com/"),
        "http://h.net?x=/es/": ("h.net", "", None),
        "nothing": ("", "", None),
        None: ("", "", None),
        "://": ("", "", None),
    }
    for url, (host, path, rule) in cases.items():
        assert split_url(url)[:2] == (host, path)
        assert rules.match(host, path) == rule


def test_url_filter(spark):
    rules = Rules({"good.org/": "allow", "bad.biz/": "block"})
    rows = [(k, f"http://n{k}.{'good.org' if k % 2 else 'bad.biz'}/p{k}/{'x' * (k % 2)}") for k in range(300)]
    rows += [(900, None), (901, ""), (902, "http://other.biz/p1/"), (903, "http://other.org/p1/x"), (3, rows[3][1])]
    rows += [(904, "http://n7.other.net/p7/x"), (905, "http://n8.other.net/p8/"), (906, "http://n8.bad.biz/" + "y" * 200_000)]
    pages = spark.createDataFrame([(*r, "h") for r in rows], "page_id long, url string, score string")
    found = judge_urls(pages, rules, fit_url_model(pages, rules)).collect()
    got = {r.page_id: r for r in found}
    assert len(found) == len(rows) and got[1].verdict == "allow" and got[2].verdict == "block"
    assert got[902].rule is None and got[902].verdict == "block" and got[903].verdict == "allow"
    assert got[904].verdict == "allow" and got[905].verdict == "block"  # an unknown suffix is judged by its form
    none = fit_url_model(pages.limit(0), rules)
    assert judge_urls(pages.limit(0), rules, none).count() == 0 and none.score([None])[0] < 0.5


def test_boosted_trees_learn_an_interaction():
    rng = np.random.default_rng(1)
    x = rng.random((800, 3))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    assert ((BoostedTrees().fit(x, y).score(x) >= 0.5) == y).mean() > 0.95


def test_quality(spark):
    rng = random.Random(7)
    clean = [(k, " ".join(rng.choice("abcdefgh") * rng.randint(2, 6) + str(rng.randrange(500)) for _ in range(60)), "en", "s", "x", 1) for k in range(80)]
    odd = [
        (100, "a b c", "en", "s", "x", 1),
        (101, "one two three four five six seven eight " * 10, "en", "s", "x", 1),
        (102, " ".join(f"x{k}$$$%%%&&&" for k in range(60)), "en", "s", "x", 1),
        (103, None, None, None, "x", 1),
        (104, "", "en", "s", "x", 1),
        (0, clean[0][1], "en", "s", "x", 1),
    ]
    got = {r.doc_id: r for r in quality_verdicts(spark.createDataFrame([*clean, *odd], SCHEMA)).collect()}
    assert all(got[k].kept for k in range(80))
    assert got[100].base_failed and got[101].base_failed and got[101].n_repeat_words == 80
    assert not got[102].base_failed and not got[102].kept and got[102].n_symbols == 540
    assert got[103].n_words == 0 and not got[103].kept and not got[104].kept
    assert quality_verdicts(spark.createDataFrame([], SCHEMA)).count() == 0


def test_quality_of_repeated_lines_and_small_groups(spark):
    rng = random.Random(8)
    line = lambda: " ".join(rng.choice("abcdefgh") * rng.randint(2, 6) + str(rng.randrange(500)) for _ in range(10))
    rows = [(k, "\n".join(line() for _ in range(8)), "en", "s" if k < 80 else "small", "x", 1) for k in range(90)]
    once = line()
    some = "\n".join(x for _ in range(6) for x in (line(), "often"))
    rows += [
        (100, "\n".join([once, *(line() for _ in range(7)), once]), "en", "s", "x", 1),
        (101, some, "en", "s", "x", 1),
        (102, some, "en", "small", "x", 1),  # judged by its language's limits
        (103, "\n".join(line() for _ in range(8)), None, None, "x", 1),
    ]
    got = {r.doc_id: r for r in quality_verdicts(spark.createDataFrame(rows, SCHEMA), k=8).collect()}
    assert [k for k in [*range(90), 100, 103] if not got[k].kept] == []
    assert not any(got[k].base_failed for k in (100, 101, 102)) and not got[101].kept and not got[102].kept


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("a b c d e f g h a b c d e f g h", (16, 16, 0, 0, 16)),
        ("x y\nx y\n \n\nx y ", (6, 6, 0, 1, 0)),
        ("é#\u00a0ü $", (2, 5, 2, 0, 0)),
    ],
)
def test_base_measures(spark, text, want):
    r = quality_verdicts(spark.createDataFrame([(1, text, "en", "s", "x", 1)], SCHEMA)).first()
    assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want


def test_dictionaries_of_a_language_of_mostly_copies(spark):
    spread = spark.range(300_000).selectExpr("'aa' AS lang", "IF(id < 299000, 'one text over and over', concat('text number ', id)) AS text")
    assert learn_dictionaries(spread)["aa"].count(b"text number") >= 390
