"""Packing, leakage and residue: edge cases and brute-force versions."""

from __future__ import annotations

import random

import pytest

from lodestrom.llm import leakage, packing, queries, residue
from tests.conftest import DATA


def rows(df, *columns):
    return sorted(tuple(r) for r in (df.select(*columns) if columns else df).collect())


# --- 8: packing
def held(plan):
    counts: dict[int, int] = {}
    for n, sizes in plan:
        for s, each in sizes.items():
            counts[s] = counts.get(s, 0) + n * each
    return counts


@pytest.mark.parametrize("seed", range(30))
def test_plan_holds_everything_within_capacity(seed):
    rng = random.Random(seed)
    capacity = rng.choice([10, 60, 2048])
    counts = {rng.randint(1, capacity): rng.randint(1, 300) for _ in range(rng.randint(0, 60))}
    plan = packing.plan_containers(counts, capacity)
    assert held(plan) == counts
    for n, sizes in plan:
        assert n > 0 and 0 < sum(s * k for s, k in sizes.items()) <= capacity
        assert sum(k for s, k in sizes.items() if 3 * s > capacity) <= 2
    containers, least = sum(n for n, _ in plan), sum(s * n for s, n in counts.items()) / capacity
    assert containers <= 1.5 * least + sum(n for s, n in counts.items() if 3 * s > capacity) / 2 + 1


def test_small_items_fill_the_gaps():
    assert sum(n for n, _ in packing.plan_containers({70: 10, 30: 10}, 100)) == 10
    assert sum(n for n, _ in packing.plan_containers({60: 5, 40: 5, 20: 5}, 100)) == 6
    assert packing.plan_containers({}, 100) == []
    with pytest.raises(ValueError, match="capacity"):
        packing.plan_containers({101: 1}, 100)


def test_packing_of_odd_documents(spark):
    texts = [None, "", "a", "é" * 3, "x" * 2047, "x" * 2048, "y" * 5000, "z" * 4095, "a", "a"]
    df = spark.createDataFrame([(i if i < 9 else 2, t, "clash", i) for i, t in enumerate(texts)], "doc_id long, text string, container string, size int")
    packed = packing.pack(df)
    got = {(r.doc_id, r.piece): (r.start, r.size) for r in packed.collect()}
    assert got == {(1, 0): (0, 1), (2, 0): (0, 2), (3, 0): (0, 7), (4, 0): (0, 2048), (5, 0): (0, 2048), (5, 1): (2048, 1), (6, 0): (0, 2048), (6, 1): (2048, 2048), (6, 2): (4096, 905), (7, 0): (0, 2048), (7, 1): (2048, 2048), (8, 0): (0, 2)}
    assert all(u <= 2048 for _, u in rows(packed.groupBy("container").sum("size")))
    assert rows(packing.split_documents(packed)) == [(5,), (6,), (7,)]
    assert rows(packing.pack(df.where("false"))) == [] and packing.fill_report(packing.pack(df.where("false"))).first()["containers"] == 0


def test_one_size_in_most_rows_is_ranked_in_parts(spark, monkeypatch):
    monkeypatch.setattr(packing, "RANK_ROWS", 50)
    df = spark.range(2000).selectExpr("id as doc_id", "repeat('x', cast(if(id % 3 = 0, id % 900, 700) as int)) as text")
    packed = packing.pack(df)
    assert packed.count() == 2000
    used = [u for _, u in rows(packed.groupBy("container").sum("size"))]
    large = packed.where("3 * size > 2048").count()  # two to a container at most
    assert max(used) <= 2048 and len(used) <= 1.02 * max(sum(used) / 2048, large / 2)


# --- 9: leakage
def brute_leaks(docs, items, least=12):
    found = set()
    for d, text in docs:
        w = leakage.words_of(text)
        for i, item in items:
            v = leakage.words_of(item)
            k = min(least, len(v))
            grams = {tuple(v[j : j + k]) for j in range(len(v) - k + 1)} if v else set()
            if any(tuple(w[j : j + k]) in grams for j in range(len(w) - k + 1)):
                found.add((d, i))
    return sorted(found)


def test_leaks_equal_brute_force(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(6)]
    some = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = [(i, some(rng.choice([1, 2, 5, 11, 12, 13, 30]))) for i in range(60)]
    items += [(100, items[5][1]), (101, None), (102, " ... ")]
    docs = [(d, some(40)) for d in range(60)] + [(d + 100, some(10) + " " + items[d][1].upper() + ", " + some(10)) for d in range(60)] + [(300, None), (301, ""), (0, some(3))]
    di = spark.createDataFrame(docs, "doc_id long, text string")
    it = spark.createDataFrame([(i, t, "clash") for i, t in items], "item_id long, item_text string, doc_id string")
    for most in (10**6, 40):  # one automaton, and many
        automata = list(leakage.build_automata(it, most_words=most))
        assert (len(automata) == 1) == (most == 10**6)
        assert rows(leakage.find_leaks(di, automata), "doc_id", "item_id") == brute_leaks(docs, items)
    assert rows(leakage.find_leaks(di.where("false"), automata)) == [] == rows(leakage.find_leaks(di, leakage.build_automata(it.where("false"))))


def test_words_are_normalised():
    assert leakage.words_of("L'ÉCOLE—Straße ﬁn x² naïve_2 ‘n") == ["l", "ecole", "strasse", "fin", "x2", "naive", "2", "n"]
    assert leakage.words_of(None) == leakage.words_of(" .;— ") == []
    text = "Ünï, ﬁn—x²!"
    assert [text[a:b] for _, a, b in leakage.words_with_spans(text)] == ["Ünï", "ﬁn", "x²"]
    assert [w for w, _, _ in leakage.words_with_spans(text)] == leakage.words_of(text)


def test_leaked_spans_are_cut(spark):
    passage = "one two three four five six seven eight nine ten eleven twelve thirteen"
    docs = spark.createDataFrame([(1, f"Before {passage.upper()}, after all of this there is much more text that stays here for good."), (2, passage), (3, "clean"), (4, None)], "doc_id long, text string")
    other = " ".join(f"q{i}" for i in range(12))
    items = spark.createDataFrame([(9, passage), (10, other)], "item_id long, item_text string")
    for most in (10**6, 10):  # in one pass, and in two
        check_cut(docs, list(leakage.build_automata(items, most_words=most)))
    long_only = leakage.remove_leaks(docs, list(leakage.build_automata(items)), most_words=13)
    assert {r.removed for r in long_only.collect()} == {0}


def check_cut(docs, automata):
    got = {r.doc_id: (r.text, r.removed, r.dropped) for r in leakage.remove_leaks(docs, automata).collect()}
    assert got[1][1:] == (13, False) and got[1][0].startswith("Before ") and "SEVEN" not in got[1][0] and got[1][0].endswith("for good.")
    assert got[2] == (None, 13, True) and got[3] == ("clean", 0, False) and 4 not in got


def test_a_very_long_text(spark):
    passage = " ".join(f"p{i}" for i in range(15))
    text = " ".join(str(i) for i in range(120_000)) + " " + passage
    automata = leakage.build_automata(spark.createDataFrame([(1, passage)], "item_id long, item_text string"))
    assert rows(leakage.find_leaks(spark.createDataFrame([(1, text)], "doc_id long, text string"), automata), "doc_id", "item_id") == [(1, 1)]


# --- 10: residue
RESIDUE = [
    "Dear {{first_name}}, hello", "a {name} b", "x ${total} y", "#{ref}", "{% city %}", "<%= x %>", "<<NAME>> here", "go <ORDER_TOTAL> now", "&lt;ref_no&gt;", "[[x]]", "see [first_name]", "[Your Name] here", "[TODO: address]", "[XX/XX/XXXX]", "(insert date here)",
    "the %s rain", "%(name)s", "%due_date%", "$ref_no$", "@@X@@", "##x_y##", "*|NAME|*", "__last_name__", "{0} and", "{date:dd.MM}",
    "Lorem ipsum dolor sit amet consectetur", "xxx xxx xxx", "blah blah", "foo test jkl", "Text.\nInsert a headline here", "Hier Text einfügen", "Ajoutez un titre dans ce cadre", "Tik jou teks hier by", "Dummy text, not final.",
    "Error 404: Not Found", "Some text here.\nBad gateway. Request id 70bac696", "ACCESS DENIED", "Traceback: line 5, in f\nValueError: x must not be empty", "La página solicitada devolvió un error interno", "Der Server ist derzeit nicht erreichbar. Bitte versuchen Sie es später erneut",
    "Please enable JavaScript to view this content", "<noscript>Scripts are required by this page.</noscript>", "Esta página requiere scripts activados\nReal text follows with its own words.", "Skakel asseblief skrips aan in jou blaaier",
]
CLEAN = [
    None, "", "   ", "In the song, Osqui repeats [chorus] 716 times.", "Roso writes sets such as {1, 2, 298} on the board.", "Rekly paid $40 to $90 for access that was denied to 370 others.", "The engine of Nybezeb gained 7%, so 632 litres were saved.", "Zebnalin drew a 404 on the door of room 273.",
    "Katam erklärt auf 628 Seiten, warum manche Leute JavaScript nicht aktivieren.", "Braro enseña JavaScript a 482 personas.", "Wije asked how often a page was not found last year and counted 350 reports.", "The chapter on lorem ipsum in the printing course of Hanny has 575 pages.", "Nef calls every test a dummy run, 9 in all.",
    "Use <b>bold</b> and <br> here.", "a < b and c > d", "5 % of it, 10 % de plus", "He said it [sic] twice.", "See note [1].", "word", "x" * 200_000, "[" * 20_000, "{" * 20_000,
]


def test_residue_and_clean_text(spark):
    texts = [*RESIDUE, *CLEAN]
    df = spark.createDataFrame([(i, t, "clash", f"b{i}", "s") for i, t in enumerate(texts)], "doc_id long, text string, kind string, bundle_id string, source string")
    got = {r.doc_id for r in residue.find_residue(df).collect()}
    assert [texts[i] for i in range(len(RESIDUE)) if i not in got] == []
    assert [str(texts[i])[:60] for i in range(len(RESIDUE), len(texts)) if i in got] == []
    assert rows(residue.find_residue(df.where("false"))) == []


@pytest.mark.parametrize("name", [n for n in queries.QUERIES])
def test_queries_run(spark, name):
    assert queries.QUERIES[name](spark, str(DATA)).count() > 0
