"""Word runs, fill-in-the-middle and decontamination against plain Python over small corpora."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
import regex
from pyspark.sql import functions as F

from basketlens.llm import decontam, infill, runs
from tests.llm.fixtures import by_id, documents, no_documents

SPACE = re.compile(r"[^\x20\x09-\x0D]+")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


@pytest.fixture(scope="module")
def docs(spark):
    table = documents(spark).persist()
    yield table
    table.unpersist()


@pytest.fixture(scope="module")
def plain(docs):
    return {r["doc_id"]: r["text"] for r in docs.collect()}


# ---- 11 ----


def all_runs(words, min_length=6, exponent=4):
    """Every stretch that a period q holds together and no neighbour extends, unless a smaller one does so, too."""
    out, n = set(), len(words)
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            smaller = any(all(words[x] == words[x + r] for x in range(i, i + length - r)) for r in range(1, q))
            if length >= max(min_length, exponent * q) and not smaller:
                out.add((i, length, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(words, found):
    gone = {i for start, length, q in found for i in range(start + q, start + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


@pytest.mark.parametrize("letters", [1, 2, 3, 6])
def test_runs_of_random_strings(letters):
    rng = random.Random(letters)
    for _ in range(150):
        parts = [[rng.randrange(letters) for _ in range(rng.randint(1, 9))] * rng.randint(1, 7) for _ in range(rng.randint(1, 5))]
        string = sum(parts, [])
        assert [tuple(r) for r in runs.word_runs(np.array(string), 6, 4).tolist()] == all_runs(string)
        assert [tuple(r) for r in runs.word_runs(np.array(string), 2, 3).tolist()] == all_runs(string, 2, 3)
    assert len(runs.word_runs(np.zeros(0, np.int64), 6, 4)) == 0
    with pytest.raises(ValueError, match="exponent"):
        runs.word_runs(np.array([1]), 2, 2)


def run_texts(plain):
    rows = [(d, t) for d, t in plain.items() if d is not None]
    rows += [(500 + i, " ".join((["a"] * 3 + ["b", "c"]) * (i % 9)) + f" x{i}\n" + "é " * (i % 11)) for i in range(60)]
    return rows + [(900, "ab cd " * 9 + "ab cd"), (901, "one two " * 3000 + "three " * 3), (902, "\x1c " * 7)]


def test_with_cycles(spark, plain):
    rows = run_texts(plain)
    got = by_id(runs.with_cycles(spark.createDataFrame([*rows, (None, "no id")], "doc_id long, text string")))
    changed = 0
    for d, text in rows:
        h, words = zlib.crc32(str(d).encode()), SPACE.findall(text or "")
        g, n = h // 10, len(words)
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = words[:a] + [words[a + (i - a) % p] for i in range(a, n)]
            changed += 1
        assert SPACE.findall(got[d]["text"] or "") == words
    assert changed > 3 and got[None]["text"] == "no id"


@pytest.mark.parametrize("block", [1 << 18, 10])
def test_run_report(spark, plain, monkeypatch, block):
    monkeypatch.setattr(runs, "BLOCK_WORDS", block)
    table = runs.with_cycles(spark.createDataFrame(run_texts(plain), "doc_id long, text string").repartition(3)).persist()
    got, some = by_id(runs.run_report(table)), 0
    for r in table.collect():
        words = SPACE.findall(r["text"] or "")
        found = all_runs(words) if len(words) < 2000 or r["doc_id"] == 901 and len(words) < 9000 and not (words := words[-400:]) else None
        if found is None:
            continue
        some += len(found)
        best = max(found, key=lambda x: (x[1], -x[0], -x[2]), default=None)
        out = got[r["doc_id"]]
        assert out["n_runs"] == len(found)
        assert (out["start"], out["length"], out["period"]) == (best or (None,) * 3)
        assert out["exponent_milli"] == (best and 1000 * best[1] // best[2])
        assert out["runs_sha256"] == sha("".join(f"{s},{n},{q}\n" for s, n, q in found))
        assert out["collapsed_sha256"] == sha(collapsed(words, found))
    assert some > 20
    long = got[901]
    assert (long["n_runs"], long["start"], long["length"], long["period"], long["exponent_milli"]) == (1, 0, 6000, 2, 3_000_000)
    table.unpersist()


def test_runs_of_odd_tables(spark, docs):
    assert runs.run_report(docs).count() == docs.count()
    assert runs.run_report(no_documents(spark)).count() == 0
    empty = spark.createDataFrame([(1, None), (2, ""), (3, " \n")], "doc_id long, text string")
    assert {(r["n_words"], len(r["runs"]), r["collapsed"]) for r in runs.collapsed_runs(empty).collect()} == {(0, 0, "")}
    assert {r["runs_sha256"] for r in runs.run_report(empty).collect()} == {sha("")}


# ---- 12 ----


def expected_infill(doc_id, text, seed=1, rate=90, spm=20):
    h = [int(hashlib.sha256(f"{seed}:{doc_id}".encode()).hexdigest()[8 * i : 8 * i + 8], 16) for i in range(4)]
    n = len(text)
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return n, "plain", None, None, text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = text[:a], text[a:b], text[b:]
    out = f"<S>{s}<P>{p}<M>{m}" if h[3] % 100 < spm else f"<P>{p}<S>{s}<M>{m}"
    return n, "spm" if out.startswith("<S>") else "psm", len(p), len(m), out


def infill_texts(plain):
    rows = [(d, t) for d, t in plain.items() if d is not None]
    rows += [(600 + i, ("é日<S😀" * i)[: 3 * i] + "<" * (i % 3)) for i in range(150)]
    return rows + [(800, "a <P> b"), (801, "<M>"), (802, "<S>x"), (803, "é" * 300_000), (804, "x"), (805, "\n")]


def test_infill(spark, plain):
    rows = infill_texts(plain)
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = by_id(infill.infill_report(table))
    forms = set()
    for d, text in rows:
        n, form, prefix, middle, out = expected_infill(d, text or "")
        r = got[d]
        forms.add(form)
        assert (r["n"], r["form"], r["prefix_chars"], r["middle_chars"]) == (n, form, prefix, middle)
        assert r["output_sha256"] == sha(out) and r["restored_sha256"] == sha(text or "")
    assert forms == {"plain", "psm", "spm"} and len(got) == len(rows)


@pytest.mark.parametrize("block", [1, 2, 7, 4096])
def test_places_of_units(block):
    rng = random.Random(block)
    for _ in range(100):
        text = "".join(rng.choice(["a", "é", "日", "😀", " ", "word ", "\n"]) for _ in range(rng.randint(0, 60)))
        found = infill.UnitText(text.encode(), None, block)
        assert found.n == len(text)
        assert [found.place(u) for u in range(len(text) + 1)] == [(len(text[:u].encode()), u) for u in range(len(text) + 1)]
        pattern = regex.compile(r"\w+")
        starts = [m.start() for m in pattern.finditer(text)]
        found = infill.UnitText(text.encode(), pattern, block)
        cuts = [0, *starts[1:], len(text)] if starts else [0]
        assert found.n == len(starts)
        assert [found.place(u) for u in range(found.n + 1)] == [(len(text[:c].encode()), c) for c in cuts]


def test_infill_of_words_and_odd_tables(spark, docs):
    """Cuts of a word pattern fall on its starts; other marks; rows without id, without rows."""
    marks = ("[p]", "[s]", "[m]")
    made = infill.fill_in_middle(docs, unit=r"[A-Za-zé]+\d*", rate=100, spm=50, seed=3, marks=marks)
    back = made.withColumn("back", infill.restored(F.col("output"), F.col("form"), marks)).collect()
    texts = sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["text"] or "") for r in docs.collect())
    assert sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["back"]) for r in back) == texts
    for r in back:
        if r["form"] != "plain" and 0 < r["prefix_chars"] < len(r["back"]):
            assert re.match(r"[A-Za-zé]", r["back"][r["prefix_chars"]])
    assert infill.infill_report(no_documents(spark)).count() == 0


# ---- 13 ----

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def expected_hits(texts, items, window=10):
    places = {}
    for item, text in items:
        words = lowered(text)
        for i in range(max(1, len(words) - window + 1) if words else 0):
            places.setdefault(tuple(words[i : i + window]), set()).add(item)
    out = []
    for d, text in texts:
        words, hit, found = lowered(text), set(), set()
        for w, owners in places.items():
            for i in range(len(words) - len(w) + 1):
                if words[i] == w[0] and tuple(words[i : i + len(w)]) == w:
                    hit |= set(range(i, i + len(w)))
                    found |= owners
        found = sorted(str(i) for i in found if i is not None)
        out.append((-1 if d is None else d, len(words), len(hit), len(found), sha(",".join(found)), bool(hit)))
    return sorted(out)


def leaks():
    rng = random.Random(5)
    vocabulary = [f"W{i}" for i in range(12)] + ["Ünder", "ünder", "it's", "x-y", "3.5"]
    passage = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, passage(rng.choice([1, 2, 3, 9, 10, 11, 30, 60]) + 0)) for i in range(25)]
    items += [(100, items[3][1].upper()), (101, None), (102, " -- "), (103, "Wholly absent words that no document holds at all, not one")]
    items += [(104, "of of of of of of of of of of of of of"), (104, "a second text of the item, of more than ten words in all"), (None, items[7][1]), (105, "ΟΔΟΣ straße")]
    docs = [(i, passage(rng.randint(0, 40)) + " -- " + rng.choice(items)[1].lower().replace(" ", "\n ") + ". " + passage(5)) if i % 3 else (i, passage(60)) for i in range(60) if True]
    docs += [(70, None), (71, ""), (72, "OF " * 40), (73, "x " * 5000 + items[10][1] + " y" * 5000), (74, "the οδοσ STRAßE"), (75, "the ΟΔΟΣ Straße"), (None, items[10][1]), (None, "of " * 12), (70, docs[4][1]), docs[4]]
    return docs, items


@pytest.mark.parametrize("options", [{}, {"broadcast_rows": 7}, {"shingle": 1}, {"window": 4, "shingle": 2}])
def test_contamination(spark, monkeypatch, options):
    """Also with tables so large for their bounds that they are broadcast in parts, or shuffled."""
    if "broadcast_rows" in options:
        monkeypatch.setattr(decontam, "BROADCAST_BYTES", 0)
    texts, items = leaks()
    texts = [(d, t) for d, t in texts if t is None or "None" not in t]
    docs = spark.createDataFrame([(d, t, 1, "k", 2) for d, t in texts], "doc_id long, text string, digest int, window string, h int").repartition(3)
    table = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, length int")
    got = decontam.contamination_report(docs, table, **options).collect()
    want = expected_hits(texts, items, options.get("window", 10))
    assert sorted((-1 if r["doc_id"] is None else r["doc_id"], *r[1:]) for r in got) == want
    assert 10 < sum(w[-1] for w in want) < len(want)


def test_contamination_of_odd_tables(spark, docs):
    none = spark.createDataFrame([], "item_id string, text string")
    blank = spark.createDataFrame([("a", None), ("b", " - ")], "item_id string, text string")
    absent = spark.createDataFrame([("a", "wholly absent words")], "item_id string, text string")
    for items in (none, blank, absent):
        rows = decontam.contamination_report(docs, items).collect()
        assert len(rows) == docs.count() and {(r["n_hit"], r["n_items"], r["contaminated"]) for r in rows} == {(0, 0, False)}
    assert decontam.contamination_report(no_documents(spark), absent).count() == 0


def test_contamination_stays_in_the_jvm(spark, docs):
    items = spark.createDataFrame([("a", "one two")], "item_id string, text string")
    plan = decontam.contaminated(docs, items)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
