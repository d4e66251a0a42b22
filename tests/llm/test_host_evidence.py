"""Evidence from the corpus: lines that are spread and out of place, terms learned from them, lists that decide nothing alone."""

from __future__ import annotations

import random

import pytest

from lodestrom.llm import residue

_PLAIN = [(i, f"The clerk number {i} opens the window and counts the people at the counter.", f"b{i % 7}", "s") for i in range(600)]
_NOTICES = {
    "no key term": "Seite existiert nicht mehr, Portal Nordwind",
    "another language": "Pagina non trovata sul portale",
    "a key term": "Kindly whitelist our javascript widgets forthwith",
    "long": "Kindly whitelist our javascript widgets forthwith, " + " ".join(f"quasi{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10]}" for i in range(90)),
}


def found(spark, *extra, **how):
    df = spark.createDataFrame([*_PLAIN, *extra], "doc_id long, text string, bundle_id string, source string")
    return {r.doc_id for r in residue.find_residue(df, **how).collect()}


@pytest.mark.parametrize("line", _NOTICES.values(), ids=list(_NOTICES))
def test_any_spread_line_that_is_out_of_place(spark, line):
    notice = [(1000 + i, f"The clerk opens.\n{line}", f"b{i}", "s") for i in range(4)]
    twice = [(2000 + i, "Zwei Boten bringen Briefe", f"b{i}", "s") for i in range(2)]
    once = [(2010, "Someone elsewhere teaches javascript gladly", "b1", "s"), (2011, None, None, None)]
    assert found(spark, *notice, *twice, *once, lists=False) == {1000, 1001, 1002, 1003}


def test_null_hosts_and_sites_are_values(spark):
    line = "Pagina non trovata sul portale"
    others = [(5000 + i, f"The clerk number {i} opens.", f"b{i % 7}", None) for i in range(20)]
    assert found(spark, *others, *((1000 + i, line, b, None) for i, b in enumerate((None, "b1", "b2", None)))) == {1000, 1001, 1002, 1003}
    assert found(spark, *others, *((1000 + i, line, b, None) for i, b in enumerate((None, None, "b2", None)))) == set()


def test_what_a_site_says_throughout_is_its_own(spark):
    common = [(1000 + i, "The people opens the window at the counter", f"b{i}", "s") for i in range(4)]
    assert found(spark, *common) == set()


def test_slug_and_title_terms_are_in_place(spark):
    plain = [(i, f"The clerk number {i} opens the window.", f"b{i % 7}", "harbour_gazette") for i in range(50)]
    slug = [(1000 + i, "Harbour Gazette", f"b{i}", "harbour_gazette") for i in range(4)]
    title = [(2000 + i, f"{w} Boten bringen Briefe\nBoten bringen Briefe", f"b{i}", "harbour_gazette") for i, w in enumerate(("Zwei", "Drei", "Vier", "Elf"))]
    other = [(3000 + i, f"The clerk number {i} opens.\nPagina non trovata", f"b{i}", "harbour_gazette") for i in range(4)]
    assert found(spark, *plain, *slug, *title, *other, lists=False) == {3000, 3001, 3002, 3003}


def test_listed_words_alone_decide_nothing(spark):
    """A corpus about error pages says such words in ordinary lines; there the same line is no residue."""
    line = "Error: page not found"
    assert found(spark, (1000, line, "b1", "s")) == {1000}
    about = [(3000 + i, f"Manual {i}: the error page is not shown when the page was found at once.", "b1", "s") for i in range(400)]
    assert found(spark, (1000, line, "b1", "s"), *about) == set()


def test_recall_on_notices_of_no_list(spark):
    """Notices of an invented language, a twentieth of all texts, built from parts as notices are; some forms stand once only."""
    rng = random.Random(7)
    ask, thing, what = ("gravo", "melita"), ("kriptalo", "foliumi", "bannero"), ("vidu tion", "klaku tie")
    names = ["".join(rng.choice(("ka", "lo", "min", "ter", "bru", "sov")) for _ in range(4)) for _ in range(900)]
    plain = [(10_000 + i, f"The {rng.choice(names)} of {rng.choice(names)} opens the window and {rng.choice(names)} counts {i} people at the counter.", f"b{i % 40}", "s") for i in range(3000)]
    # mentions share a word with the notices, but have words of their own
    mention = [(4000 + i, f"The clerk Ro{'abcdefghijkl'[i]}mel asked {300 + i} people what kriptalo means to the counter.", f"b{i % 7}", "s") for i in range(12)]
    notices = [(1000 + i, ("" if i % 2 else f"The clerk number {i} opens the window.\n") + f"Bonvolu {rng.choice(ask)} {rng.choice(thing)} por {rng.choice(what)}{' kaj ' + rng.choice(thing) if i % 12 == 0 else ''}", f"b{rng.randrange(40)}", "s") for i in range(150)]
    got = found(spark, *plain, *mention, *notices, lists=False)
    assert len(got & {n[0] for n in notices}) >= 0.9 * len(notices) and not got - {n[0] for n in notices}


def test_long_placeholders_have_no_limit(spark):
    name = "x" * 5_000
    extra = [(1000, f"Dear {{{{{name}}}}}", "b1", "s"), (1001, f"see <<{name}>>", "b1", "s"), (1002, f"[[{name}", "b1", "s")]
    assert found(spark, *extra) == {1000, 1001}


@pytest.mark.parametrize("line", ["Error 404: Not Found", "404 Not Found nginx/1.18.0", "Oops! That page can't be found.", "Habilita JavaScript para visualizar esta tienda."])
def test_common_notices_where_they_are_spread(spark, line):
    assert found(spark, *((1000 + i, line, f"b{i}", "s") for i in range(3))) == {1000, 1001, 1002}


def test_the_same_beyond_the_broadcast_limit(spark, monkeypatch):
    from lodestrom.operators import joins

    notice = [(1000 + i, f"The clerk opens.\nPagina non trovata sul portale{' ora' if i > 3 else ''}", f"b{i % 4}", "s") for i in range(5)]
    extra = [*notice, (2000, "Portale non trovata", "b1", "s"), (2001, "Dear {{name}}", None, None), (2002, None, None, None), (2003, "Error: page not found", "b9", None)]
    want = found(spark, *extra)
    assert {1000, 1001, 1002, 1003, 2000, 2001, 2003} <= want
    monkeypatch.setattr(joins, "BROADCAST_BYTES", 0)
    monkeypatch.setattr(joins.skew_safe_join, "__defaults__", ("inner", 0.01, 1))
    assert found(spark, *extra) == want
