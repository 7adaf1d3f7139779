"""The glob machine against regular expressions, and the rules of the query."""

from __future__ import annotations

import random
import re

import pyarrow as pa
import pytest

from marquee.llm import urls as U


def to_regex(glob):
    parts = re.split(r"(\*\*|\*|\?)", glob)
    special = {"**": r"[\s\S]*", "*": r"[^/]*", "?": r"[\s\S]"}
    return re.compile("".join(special.get(p, re.escape(p)) for p in parts))


def test_machine_against_regular_expressions():
    rng = random.Random(9)
    globs = ["".join(rng.choice(["a", "b", "/", ".", "?", "*", "**"]) for _ in range(rng.randint(1, 12))) for _ in range(90)]
    globs += ["", "*", "**", "a" * 130 + "*b", "ü*"]
    texts = ["".join(rng.choice("ab/.c") for _ in range(rng.randint(0, 14))) for _ in range(300)] + ["", "a" * 140 + "b", "über/x"]
    assert U.GlobMachine(globs).n_words > 8
    patterns = [to_regex(g) for g in globs]
    expected = [next((k for k, p in enumerate(patterns) if p.fullmatch(text)), -1) for text in [*texts, ""]]
    # One machine, and dozens of them met by their keys.
    for machine_bits, least in ((U.MACHINE_BITS, 1), (40, 10)):
        machines = U.GlobSet(globs, machine_bits)
        assert len(machines.machines) >= least
        assert machines.first_match(pa.array([*texts, None])).tolist() == expected


def test_keys_of_globs():
    def keys(*runs):
        return {int.from_bytes(r, "little") for r in runs}

    assert U.literal_keys("*casin**") == keys(b"casi", b"asin")
    assert U.literal_keys("ab*cd?ef**gh") == set()
    assert U.literal_keys("ab*cdef") == keys(b"cdef")


def test_hundred_thousand_globs():
    rng = random.Random(10)
    syllables = [a + b for a in "bcdfglmnprst" for b in "aeiou"]
    names = sorted({"".join(rng.choice(syllables) for _ in range(rng.randint(3, 6))) for _ in range(110_000)})
    rng.shuffle(names)
    globs = [f"*{n}.**" if k % 3 else f"{n}.com/*/x**" for k, n in enumerate(names[:100_000])] + ["??", "*.q/**"]
    machines = U.GlobSet(globs)
    assert len(machines.machines) > 100 and machines.n_bytes < 64 << 20
    places = {n: k for k, n in enumerate(names[:100_000])}
    texts, expected = [], []
    for k in range(0, 100_000, 400):
        texts += [f"{names[k]}.com/a/x9", f"{names[k]}.com/a/y", names[k], "zz"]
        for text in texts[-4:]:
            ends = {text[i : text.index(".")] for i in range(text.index("."))} if "." in text else set()
            fits = [j for j in (place for place in map(places.get, ends) if place is not None) if j % 3 or (text.startswith(names[j]) and "/x" in text)]
            expected.append(100_000 if text == "zz" else min(fits, default=-1))
    assert machines.first_match(pa.array(texts)).tolist() == expected


def judged(spark, *urls):
    df = spark.createDataFrame([(k, u, "clash", "clash") for k, u in enumerate(urls)], "page_id int, url string, rule string, host string")
    out = U.filter_urls(df)
    assert out.columns == ["page_id", "url", "host", "path", "rule", "verdict", "glob"]
    return [(r.host, r.path, r.rule, r.verdict) for r in out.orderBy("page_id").collect()]


def test_rules_and_edge_urls(spark):
    long = "http://a.org/fr/" + "x" * 20000
    got = judged(
        spark,
        "http://EXAMPLE.net/en/1?q=/de/",
        "https://www.example.net/de/2",
        "http://notexample.com/de/3",
        "http://m.example.com/de/4#top",
        "http://example.com/DE/4",
        "http://x.org/fr/5",
        "http://x.org/frx",
        "http://net",
        "http://net/",
        "http://foo.com/x.net/",
        "https://casino-win.com/a",
        "https://casino-win.com",
        "https://good.com/casino",
        "mailto:x@y.net/",
        None,
        "",
        "a://b://c/d",
        long,
        "http://É.net/ü?x",
        "http://EXAMPLE.net/en/1?q=/de/",
    )
    assert got == [
        ("example.net", "/en/1", "example.net/en/", "allow"),
        ("www.example.net", "/de/2", "net/", "block"),
        ("notexample.com", "/de/3", None, "allow"),
        ("m.example.com", "/de/4", "example.com/de/", "block"),
        ("example.com", "/DE/4", None, "allow"),
        ("x.org", "/fr/5", "org/fr/", "allow"),
        ("x.org", "/frx", None, "allow"),
        ("net", "", None, "allow"),
        ("net", "/", "net/", "block"),
        ("foo.com", "/x.net/", None, "allow"),
        ("casino-win.com", "/a", None, "block"),
        ("casino-win.com", "", None, "block"),
        ("good.com", "/casino", None, "allow"),
        ("", "", None, "allow"),
        ("", "", None, "allow"),
        ("", "", None, "allow"),
        ("b:", "//c/d", None, "allow"),
        ("a.org", long[len("http://a.org") :], "org/fr/", "allow"),
        ("É.net", "/ü", "net/", "block"),
        ("example.net", "/en/1", "example.net/en/", "allow"),
    ]


def test_globs_of_a_table(spark):
    listed = ["*pills**", None, "", "*pills**", "*.bad-host.org/**"] + [f"*never{k}x**" for k in range(2000)]
    globs = spark.createDataFrame([(g,) for g in listed], "glob string")
    urls = ["http://cheap-pills.com/a", "http://a.bad-host.org/x", "http://a.org/fr/pills", "http://never7x.com", "http://never7.com", None]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id int, url string")
    out = U.filter_urls(pages, junk_globs=globs)
    got = [(r.rule, r.verdict, r.glob) for r in out.orderBy("page_id").collect()]
    assert got == [
        (None, "block", "*pills**"),
        (None, "block", "*.bad-host.org/**"),
        ("org/fr/", "allow", "*.org/fr/**"),
        (None, "block", "*never7x**"),
        (None, "allow", None),
        (None, "allow", None),
    ]
    assert out._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    none = U.filter_urls(pages, rules=[], junk_globs=globs.limit(0))
    assert {(r.rule, r.verdict, r.glob) for r in none.collect()} == {(None, "allow", None)}


def test_too_many_globs_to_broadcast(spark, monkeypatch):
    monkeypatch.setattr(U, "MAX_GLOB_BYTES", 100)
    pages = spark.createDataFrame([(1, "http://a.b/c")], "page_id int, url string")
    with pytest.raises(ValueError, match="globs"):
        U.filter_urls(pages, junk_globs=spark.range(50).selectExpr("concat('*', id, 'x**') glob"))


def test_empty_table(spark):
    assert U.url_report(spark.createDataFrame([], "page_id bigint, url string, html string")).count() == 0
