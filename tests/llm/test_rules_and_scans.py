"""Rule ledger (op5), licence scans (op6), containment (op8) against brute force."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from dimload.llm import containment, licences, rule_ledger

from .conftest import HARD, LOW

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def measures(text):
    text = text or ""
    w = WORD.findall(text)
    windows = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    covered = {i + k for i in range(len(w) - 4) if windows[tuple(w[i : i + 5])] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return {
        "n_words": len(w),
        "word_chars": sum(map(len, w)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_lines": len(lines),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
        "n_upper": len(re.findall("[A-Z]", text)),
        "n_letters": len(re.findall("[A-Za-z]", text)),
        "n_marks": len(re.findall("[!?]", text)),
    }


def failed(m):
    return sum(1 << k for k, rule in enumerate(rule_ledger.RULES.values()) if (lambda x: x[0] > x[1])(rule(m)))


def test_ledger_equals_brute_force(hard):
    rows = rule_ledger.ledger(hard).collect()
    want = sorted(((r[0] or 0, *(m := measures(r[1])).values(), failed(m)) for r in HARD))
    assert sorted((r["doc_id"] or 0, *[r[c] for c in rule_ledger.MEASURES], r["failed"]) for r in rows) == want


def test_keep_passes_rows_and_columns_through(hard):
    kept = rule_ledger.keep(hard)
    assert kept.schema == hard.schema
    mask = rule_ledger.mask(rule_ledger.VERSION)
    want = sorted((r[0] or 0 for r in HARD if not failed(measures(r[1])) & mask))
    assert sorted(r["doc_id"] or 0 for r in kept.collect()) == want and kept.first()["score"] == "kept"


def test_policies_and_ablations(spark):
    texts = ["clean words of a text that is long enough to be kept"] * 3 + ["a # b # c # d # e # f # g # h # i # j #"] * 2 + ["few"]
    rows = rule_ledger.ledger(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert rows.where(rule_ledger.passes(1)).count() == 5 and rows.where(rule_ledger.passes(2)).count() == 3
    got = {(r["policy"], r["rule"]): (r["n_failed"], r["n_only_rule"]) for r in rule_ledger.ablations(rows).collect()}
    assert got[1, "few_words"] == (1, 1) and got[2, "symbols"] == (2, 2) and got[2, "upper_case"] == (0, 0)


def test_empty_tables(spark, empty):
    assert rule_ledger.ledger(empty).collect() == [] and rule_ledger.keep(empty).collect() == []
    assert {r["n_failed"] for r in rule_ledger.ablations(rule_ledger.ledger(empty)).collect()} == {0}
    assert licences.scan(empty).collect() == []
    items = spark.createDataFrame([], "item_id long, text string")
    assert containment.contaminated(empty, items).collect() == [] and containment.keep(empty, items).collect() == []


# --- licences


def test_automaton_matching_statistics():
    rng = random.Random(4)
    sequences = [[rng.randrange(4) for _ in range(12)] for _ in range(5)]
    automaton = licences.SuffixAutomaton(sequences)
    for _ in range(200):
        run = [rng.randrange(4) for _ in range(rng.randrange(1, 20))]
        runs = {tuple(s[i:j]) for s in sequences for i in range(len(s)) for j in range(i + 1, len(s) + 1)}
        longest = [max((n for n in range(i + 2) if n == 0 or tuple(run[i + 1 - n : i + 1]) in runs)) for i in range(len(run))]
        want = [(i, n) for i, n in enumerate(longest) if n >= 2 and (i + 1 == len(run) or longest[i + 1] <= n)]
        got = list(automaton.matches(run, 2))
        assert [(i, n) for i, n, _ in got] == want
        for i, n, state in got:
            ends = [(k, e) for k, s in enumerate(sequences) for e in range(n - 1, len(s)) if s[e + 1 - n : e + 1] == run[i + 1 - n : i + 1]]
            assert automaton.places[state] == ends


def test_licence_rows(spark, hard):
    texts = {
        1: "Some text.\nThis work is licensed under the GNU General Public License, version 3.",
        2: "All Rights Reserved, all rights reserved! CC-BY",
        3: "Permission is hereby granted, free of charge, to any and every person obtaining a copy of this software",
        4: "general public  license_all rights",
        5: None,
        6: "",
    }
    rows = {r["doc_id"]: r for r in licences.scan(spark.createDataFrame(list(texts.items()), "doc_id long, text string")).collect()}
    assert rows[1]["labels"] == "gpl,gpl-3.0" and rows[1]["base_labels"] == "gpl" and rows[1]["first_word"] == 9
    assert rows[1]["spans"][0]["label"] == "gpl-3.0" and (rows[1]["spans"][0]["first"], rows[1]["spans"][0]["last"]) == (2, 13)
    assert (rows[2]["n_base"], rows[2]["first_word"], rows[2]["last_word"], rows[2]["base_labels"]) == (3, 0, 6, "cc-by,reserved")
    assert rows[3]["labels"] == "mit" and 0.8 <= rows[3]["score"] < 1 and rows[3]["n_base"] == 0
    assert rows[4]["base_labels"] == "gpl"
    for k in (5, 6):
        assert (rows[k]["n_words"], rows[k]["first_word"], rows[k]["labels"], rows[k]["score"]) == (0, None, "", 0.0)
    assert licences.scan(hard).count() == len(HARD)


def labels_of(spark, texts, **more):
    rows = licences.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), **more).collect()
    return {r["doc_id"]: {x["label"] for x in r["spans"]} for r in rows}


def test_whole_licence_texts(spark):
    bodies = dict(licences.default_templates()[:18])
    assert {"mit", "bsd-2-clause", "bsd-3-clause", "apache-2.0", "gpl-2.0", "gpl-3.0", "lgpl-2.1", "cc0-1.0"} <= set(bodies)
    late = [" ".join(text.split()[15:]) for text in bodies.values()]  # without the opening words
    got = labels_of(spark, late)
    for k, label in enumerate(bodies):
        assert label in got[k], label
    assert labels_of(spark, ["one own template of words"], templates=[("own", "own template of words")]) == {0: {"own"}}


def test_words_in_gaps_and_overlapping_templates(spark):
    work = "This work is licensed under "
    texts = {
        work + "a Creative Commons Attribution-ShareAlike 4.0 International License": {"cc-by-sa-4.0"},
        work + "a Creative Commons Attribution-NonCommercial-NoDerivatives 4.0 International License": {"cc-by-nc-nd-4.0"},
        work + "the GNU Lesser General Public License, version 3": {"lgpl-3.0"},
        work + "the GNU Affero General Public License, version 3": {"agpl-3.0"},
        work + "the GNU General Public License, version 3": {"gpl-3.0"},
        work + "the GNU General Public License, version 2. Released under the MIT License.": {"gpl-2.0", "mit"},
    }
    assert list(labels_of(spark, list(texts)).values()) == list(texts.values())
    two = [("plain", "a b c d e f g h i j"), ("odd", "a b c d e x y z f g h i j")]
    mixed = ["a b c d e f g h i j", "a b c d e x y z f g h i j", "a b c d e q r s f g h i j", "a b c d e f q g h i j a b c d e x y z f g h i j"]
    assert labels_of(spark, mixed, templates=two) == {0: {"plain"}, 1: {"odd"}, 2: set(), 3: {"plain", "odd"}}


def test_edited_licences_keep_their_labels(spark):
    """A sentence that repeats the licence's last words in its middle, or a footer on every page."""
    bodies = dict(licences.default_templates()[:18])
    texts, want = [], []
    for label in ("apache-2.0", "gpl-3.0", "mpl-2.0"):
        w = bodies[label].split()
        texts.append(" ".join([*w[: len(w) // 2], "see also", *w[-4:], *w[len(w) // 2 :]]))
        texts.append(" ".join(" ".join([*w[i : i + 300], "page of the license"]) for i in range(0, len(w), 300)))
        want += [label, label]
    got = labels_of(spark, texts)
    assert [label in got[k] for k, label in enumerate(want)] == [True] * 6


def brute_spans(text, table):
    """The best chains of all maximal matches, place by place, and the disjoint spans of the best ones."""
    words = [licences.words_of(t) for _, t in table]
    known = {w for t in words for w in t}
    runs = {tuple(t[i:j]) for t in words for i in range(len(t)) for j in range(i + 1, len(t) + 1)}
    w = licences.words_of(text)
    longest = [max(n for n in range(i + 2) if n == 0 or tuple(w[i + 1 - n : i + 1]) in runs) for i in range(len(w))]
    ends = [i for i, n in enumerate(longest) if n >= licences.LEAST and (i + 1 == len(w) or longest[i + 1] <= n)]
    found, best = [], 0.0
    for (label, _), t in zip(table, words, strict=True):
        chains = []  # (text end, template end, covered, first word)
        for i in ends:
            n = longest[i]
            fresh = []
            for place in range(n - 1, len(t)):
                if t[place + 1 - n : place + 1] != w[i + 1 - n : i + 1]:
                    continue
                options = [(n, i - n + 1)]
                for before, theirs, covered, first in chains:
                    if before < i and theirs < place and i - n + 1 - before <= licences.GAP + 1:
                        added = min(n, place - theirs, i - before)
                        options.append((covered + added - (i - before - added), first))
                fresh.append((i, place, *max(options)))
            chains += fresh
        for end, _, covered, first in chains:
            best = max(best, covered / len(t))
            if covered >= licences.COVER * len(t):
                found.append((covered, covered / len(t), label, first, end))
    out = []
    for _, share, label, start, end in sorted(found, key=lambda x: (-x[0], -x[1], *x[2:])):
        if all(end < a or start > b for _, a, b, _ in out):
            out.append((label, start, end, share))
    assert known
    return sorted(out, key=lambda x: x[1]), best


@pytest.mark.parametrize("seed", range(4))
def test_chains_equal_brute_force(seed):
    rng = random.Random(seed)
    letters = [f"w{i}" for i in range(rng.choice([3, 8, 40]))]
    table = tuple((f"t{k}", " ".join(rng.choice(letters) for _ in range(rng.randrange(4, 30)))) for k in range(5))
    numbers, _, _, _ = licences._templates(table)
    for _ in range(60):
        text = []
        for _ in range(rng.randrange(1, 4)):
            w = rng.choice(table)[1].split()
            for _ in range(rng.randrange(4)):
                at = rng.randrange(len(w) + 1)
                w[at : at + rng.randrange(3)] = [rng.choice([*letters, "other"]) for _ in range(rng.randrange(4))]
            text += w + ["foreign"] * rng.randrange(14)
        codes = np.array([numbers.get(x, -1) for x in licences.words_of(" ".join(text))], np.int64)
        got, best = licences.spans(codes, table)
        want, most = brute_spans(" ".join(text), table)
        assert got == want
        assert best == pytest.approx(most) if most >= licences.COVER else best <= most + 1e-9


def test_phrases_equal_brute_force(spark):
    rng = random.Random(6)
    pool = "cc by general public license all rights reserved CC BY other x.".split()
    rows = [(i, rng.choice([" ", "-", "\n"]).join(rng.choice(pool) for _ in range(rng.randrange(40)))) for i in range(200)]
    got = {r["doc_id"]: r for r in licences.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, text in rows:
        w = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text.translate(LOW))
        at = [(k, label) for p, label in licences.PHRASES.items() for k in range(len(w)) if w[k : k + len(p.split())] == p.split()]
        r = got[i]
        assert (r["n_words"], r["n_base"], r["base_labels"]) == (len(w), len(at), ",".join(sorted({x for _, x in at})))
        assert (r["first_word"], r["last_word"]) == ((min(at)[0], max(at)[0]) if at else (None, None))


# --- containment


def grams(text, width):
    w = WORD.findall((text or "").translate(LOW))
    return {tuple(w[i : i + width]) for i in range(len(w) - width + 1)}


def contained(docs, items):
    out = set()
    for item_id, item in items:
        width = min(5, len(WORD.findall(item or "")))
        mine = grams(item, width) if width else set()
        for doc_id, text in docs:
            hit = len(mine & grams(text, width)) if mine else 0
            if mine and hit * 100 >= 80 * len(mine):
                out.add((doc_id, item_id, len(mine), hit))
    return out


def test_containment_equals_brute_force(spark):
    rng = random.Random(9)
    words = [f"w{i}" for i in range(60)]
    items = [(i, " ".join(rng.choice(words) for _ in range(rng.choice([1, 2, 3, 4, 5, 6, 7, 8, 9, 15, 16, 17, 31, 32, 33, 60])))) for i in range(60)]
    items += [(100, None), (101, " "), (102, items[40][1]), (103, "a a a a a a a a")]
    docs = []
    for d in range(150):
        text = [rng.choice(words) for _ in range(rng.randrange(0, 200))]
        for _ in range(rng.randrange(3)):
            w = (rng.choice(items)[1] or "").upper().split()
            for _ in range(rng.randrange(3)):
                if w:
                    w[rng.choice([0, -1, rng.randrange(len(w))])] = "changed"
            at = rng.randrange(len(text) + 1)
            text[at:at] = w
        docs.append((d, rng.choice([" ", "\n", " \t "]).join(text)))
    docs += [(200, None), (201, ""), (202, " "), (203, "a a a a a")]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(4)
    got = containment.contaminated(df, spark.createDataFrame(items, "item_id long, text string"))
    assert {(r["doc_id"], r["item_id"], r["n_shingles"], r["n_found"]) for r in got.collect()} == contained(docs, items)


@pytest.mark.parametrize("n", range(1, 200))
def test_sketches_never_miss(n):
    """A sketch's hits left after losing all the slack are at least one."""
    slack = n - -(-n * 80 // 100)
    upper = (1 << n.bit_length()) - 1
    size = min(n, 2 * (upper - -(-upper * 80 // 100)) + 1)
    assert size - slack >= 1


def test_containment_on_hard_rows(spark, hard):
    items = spark.createDataFrame([(1, "Seven eight nine ten eleven twelve"), (2, "lone"), (3, "two words"), (None, "one"), (4, None)], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in containment.contaminated(hard, items).collect()}
    assert got == {(1, 1), (2, 1), (12, 2), (6, 3), (7, 3)}
    kept = containment.keep(hard, items)
    assert kept.columns == hard.columns and sorted(r["doc_id"] or 0 for r in kept.collect()) == [0, 3, 4, 5, 8, 9, 10, 11]


def test_rows_without_an_id_are_searched_too(spark):
    leak = "x " * 9 + "one two three four five six seven"
    docs = spark.createDataFrame([(None, leak), (None, "a clean text of some words"), (1, leak), (2, "fine words here"), (None, None)], "doc_id long, text string")
    items = spark.createDataFrame([(None, "one two three four five six seven"), (None, None), (5, "not in any of them at all")], "item_id long, text string")
    kept = sorted((r["doc_id"] or 0, r["text"] or "") for r in containment.keep(docs, items).collect())
    assert kept == [(0, ""), (0, "a clean text of some words"), (2, "fine words here")]


def test_files_of_containment_follow_the_inputs(spark, tmp_path, monkeypatch):
    """Not the partitions of a shuffle: each file costs its task a process or two."""
    run = ["first"]
    monkeypatch.setattr(containment, "scratch_path", lambda _, name: str(tmp_path / run[0] / name))
    items = [(i, " ".join(f"i{i}w{k}" for k in range(12))) for i in range(40)]
    docs = [(d, f"start {items[d % 40][1]} end") for d in range(400)]
    df = spark.createDataFrame(docs, "doc_id long, text string").coalesce(2)
    held = {"spark.sql.shuffle.partitions": "50", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        benchmark = spark.createDataFrame(items, "item_id long, text string").coalesce(1)
        containment.contaminated(df, benchmark).write.parquet(str(tmp_path / "first" / "result"))
        run[0] = "second"
        assert containment.keep(df, benchmark.where("item_id > 0")).count() == 10
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    got = spark.read.parquet(str(tmp_path / "first" / "result"))
    assert {(r["doc_id"], r["item_id"], r["n_shingles"], r["n_found"]) for r in got.collect()} == contained(docs, items)
    for at, others in (("first", {"candidates": 1, "result": 1}), ("second", {"candidates": 1, "contaminated": 1})):
        files = {p.name: len([*p.glob("part-*")]) for p in (tmp_path / at).iterdir()}
        assert files.pop("item-shingles") <= containment.FILES_A_SPLIT and files.pop("sketches") <= containment.FILES_A_SPLIT
        assert files == others


def test_no_python_runs_in_containment(hard, spark):
    items = spark.createDataFrame([(1, "seven eight nine ten eleven twelve")], "item_id long, text string")
    plan = containment.contaminated(hard, items)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_byte_counts():
    offsets, raw = np.array([0, 2, 5]), b"a!?!b"
    assert rule_ledger._class_counts(offsets, raw, b"!?").tolist() == [1, 2]
