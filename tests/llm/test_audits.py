"""Url verdicts, the filter audit and source divergence: odd rows against DuckDB, parts against brute force."""

import random
from bisect import bisect_left
from collections import Counter

import duckdb
import oracle
import pytest
from candlewick.llm import divergence, filteraudit, neardup, urls
from candlewick.llm.oracles import DIVERGENCE, FILTER_AUDIT, ORACLES
from candlewick.llm.transducer import Transducer, build
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

DOCS = "doc_id long, text string, lang string, source string"
CLASHES = ("row", "part", "filter", "failing", "digest", "p", "q", "n", "ordinal", "block", "good", "host", "path", "rule")


def cluttered(rows):
    """The same rows with columns named as the operators' own."""
    return rows.withColumns({name: F.lit("clash") for name in CLASHES})


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls everywhere, empty and very long texts, ties, repeated rows and ids, a group without terms."""
    pick = random.Random(3)
    long = " ".join(pick.choice(["Straße", "naïve", "ÉTÉ", "été", "日本語", "Zebra", "alpha-beta", "x#1"]) for _ in range(40_000))
    words = ["one", "Two", "three", "FOUR", "fünf", "six", "日本", "zzz"]
    rows = [
        (1, None, "en", "a"), (2, "", None, None), (3, " \n ", "en", "b"), (4, "same text", "en", "a"), (4, "same text", "en", "a"),
        (4, "other text", "en", "a"), (5, "same text", "de", None), (None, "same text", "en", "c"), (None, None, None, None),
        (7, long, "xx", "a"), (8, long, "xx", "b"), (9, long, "xx", "b"), (10, "12 34 #", "no", "only"), (11, "56", "no", "marks"),
    ]
    for i in range(20, 80):
        text = " ".join(pick.choices(words, k=pick.choice([3, 50, 210, 300])))
        rows.append((i, text if i % 7 else "same text", pick.choice(["en", "de"]), pick.choice("abc")))
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def labels(spark):
    rows = [(1, 1, 0), (4, 0, 1), (4, 1, None), (5, None, None), (None, 1, 1), *((i, i % 2, i % 3 // 2) for i in range(20, 60))]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


def tables(**frames):
    con = duckdb.connect()
    for name, rows in frames.items():
        con.register(name, rows.toArrow())
    return con


def test_audit_of_odd_rows_matches_duckdb(spark, odd, labels):
    found = filteraudit.audit(cluttered(odd), cluttered(labels))
    assert oracle.differences(found, tables(documents=odd, labels=labels), FILTER_AUDIT) == ""
    for docs, marks in ((odd.limit(0), labels), (odd, labels.limit(0))):
        assert oracle.differences(filteraudit.audit(docs, marks), tables(documents=docs, labels=marks), FILTER_AUDIT) == ""


def test_audit_by_hand(spark):
    """Three rows: short with a mark, a copy of it, and one that passes all but the number of words."""
    docs = spark.createDataFrame([(1, "a #", "en", "s"), (2, "a #", "en", "s"), (3, "a b", "en", "s")], DOCS)
    marks = spark.createDataFrame([(1, 1, 0), (2, 0, 1)], "doc_id long, quality int, toxic int")
    rows = {(r["filter_order"], r["step"]): r for r in filteraudit.audit(docs, marks).collect()}
    assert len(rows) == 600 and {r["part"] for r in rows.values()} == {"en"}
    first, last = rows["EDABC", 1], rows["EDABC", 3]
    assert (first["kept"], first["removed"], first["redundant"], first["toxic_lost"]) == (2, 1, 0, 1)
    assert (last["kept"], last["removed"], last["redundant"], last["unique_fails"]) == (0, 1, 2, 1)
    # A's share: 3 rows where it comes first of A, D, E; each order counted once
    assert last["shapley"] == sum(r["removed"] for (order, step), r in rows.items() if order[step - 1] == "A")


@pytest.mark.parametrize("shard_terms, limit", [(200_000, 1 << 26), (5, 1)])
def test_divergence_of_odd_rows_matches_duckdb(spark, odd, monkeypatch, shard_terms, limit):
    """Also with many transducers, one a pass, tiny blocks and chunks, and sums handed on all the time."""
    monkeypatch.setattr(divergence, "SHARD_TERMS", shard_terms)
    if limit == 1:
        for name, value in dict(BLOCK_TERMS=3, FLUSH_WORDS=40, FLUSH_BYTES=800, CHUNK_SOURCES=2, CELLS=4).items():
            monkeypatch.setattr(divergence, name, value)
    found = divergence.audited(cluttered(odd), limit=limit)
    assert oracle.differences(found, tables(documents=odd), DIVERGENCE) == ""


def test_divergence_of_no_rows_and_no_terms(spark, odd):
    assert divergence.audited(odd.limit(0)).collect() == []
    bare = odd.filter("lang = 'no'")
    assert [tuple(r) for r in divergence.audited(bare).orderBy("source").collect()] == [
        ("no", "marks", "pair", "only", 0, 1), ("no", "only", "pair", "marks", 0, 1),
    ]


def test_transducer_is_a_minimal_numbering():
    pick = random.Random(5)
    terms = sorted({"".join(pick.choices("abé", k=pick.randint(1, 7))).encode() for _ in range(600)} | {b"a" * 3000})
    made = Transducer(build(terms))
    assert made.size == len(terms)
    others = [term + b"a" for term in terms] + [term[:-1] for term in terms] + [b"", b"zzz", b"\xc3"]
    asked = terms + others
    want = [i if (i := bisect_left(terms, t)) < len(terms) and terms[i] == t else -1 for t in asked]
    assert made.ordinals(asked).tolist() == want
    assert [made.term(i) for i in range(len(terms))] == terms
    # as many states as the terms have different sets of endings
    endings = {}
    for term in terms:
        for cut in range(len(term) + 1):
            endings.setdefault(term[:cut], set()).add(term[cut:])
    assert len(made.ends) == len({frozenset(rest) for rest in endings.values()})
    assert Transducer(build([])).ordinals([b"", b"a"]).tolist() == [-1, -1]
    with pytest.raises(ValueError):
        build([b"b", b"a"])


def test_terms_are_those_of_the_pattern():
    import re

    text = "".join(map(chr, range(0x180))) + " Ab-Cd\u2028e日本\U0001f600Z9z\x00A"
    fold = str.maketrans(urls.UPPER, urls.LOWER)
    want = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", text.translate(fold))
    assert [term.decode() for term in divergence.terms_of(text)] == want


URLS = [
    None, "", "example.com/en/", "http://example.com", "http://example.com/", "http://EXAMPLE.com/en/x?y#z", "https://a.www.example.com/en/",
    "https://www.example.com/EN/", "http://com/", "http://xcom/", "http://.com/x", "ftp://a.net/es/", "ftp://a.net/es", "http://a.net/fr/#/es/",
    "http://net//es/", "http://spam-farm.example.org", "http://m.spam-farm.example.org:80/x", "http://m.spam-farm.example.org?x",
    "http://É.com/é", "://com/a://net/es/", "http://a.com/" + "x" * 100_000, "http://" + "a." * 50_000 + "net/es/q", "http://a\nb.com/c\nd",
    "http://user@example.com/en/", "x://", "x:///en/",
]


def test_verdicts_of_odd_urls_match_duckdb(spark):
    ids = [None, 1 << 60, *range(len(URLS) - 2)]
    pages = spark.createDataFrame([(i % 9 if i and i < 100 else i, url) for i, url in zip(ids, URLS)], "page_id long, url string")
    both = pages.unionByName(pages)
    found = urls.judged(cluttered(both), urls.entry_table(spark, urls.RULES, urls.LISTED))
    assert oracle.differences(found, tables(pages=both), ORACLES["op11_url_filter"]) == ""
    assert urls.judged(pages.limit(0), urls.entry_table(spark, urls.RULES)).collect() == []
    free = urls.judged(pages, urls.entry_table(spark, [])).collect()
    assert {(r["rule"], r["verdict"]) for r in free} == {(None, "allow")} and len(free) == len(URLS)


def test_lookup_confirms_strings_behind_equal_digests(tmp_path):
    """Nearly all keys collide, over several files; only stored keys are found, with their values."""
    keys = [f"host{i}.com/{'p' * (i % 5)}".encode() for i in range(200)]
    coarse = lambda key: xxh64_intdigest(key) % 3
    for n, part in enumerate((keys[:90], keys[90:100], keys[100:], [])):
        urls.digest_file(str(tmp_path / str(n)), [(key, key[::-1]) for key in part], coarse)
    lookup = urls.Lookup([str(tmp_path / str(n)) for n in range(4)], coarse)
    asked = [key + b"x" for key in keys] + keys + [b""]
    assert lookup.find(asked) == {200 + i: key[::-1] for i, key in enumerate(keys)}


def test_many_entries_in_small_files_match_brute_force(spark, monkeypatch):
    pick = random.Random(7)
    labels = ["a", "b", "cc", "d-d"]
    entries = {}
    for _ in range(300):
        key = (".".join(pick.choices(labels, k=pick.randint(1, 3))), pick.choice(["", "/", "/x", "/x/y", "/xé"]))
        entries[key] = pick.choice(urls.VERDICTS)
    rules = [(*key, verdict) for key, verdict in entries.items()]
    made = urls.entry_table(spark, rules[::2], rules)
    names = urls.listed_files(made, 200)
    assert len(names[0]) > 1 and len(names[1]) > 3
    monkeypatch.setattr(urls, "listed_files", lambda _: names)
    asked = [
        (i, ".".join(pick.choices(labels, k=pick.randint(1, 5))), pick.choice(["", "/", "/x", "/x/yz", "/xé", "/q"])) for i in range(500)
    ]
    pages = spark.createDataFrame([(i, f"http://{host}{path}") for i, host, path in asked], "page_id long, url string")

    def best(layer, host, path):
        fits = [(len(h) + len(p), len(h), h + p, v) for h, p, v in layer if f".{host}".endswith(f".{h}") and path.startswith(p)]
        return max(fits)[2:] if fits else None

    want = Counter()
    for i, host, path in asked:
        rule = best(rules[::2], host, path)
        verdict = rule or best(rules, host, path) or (None, "allow")
        want[i, host, path, rule and rule[0], verdict[1]] += 1
    assert Counter(map(tuple, urls.judged(pages, made).collect())) == want


@pytest.mark.parametrize("entry", [("A.com", "/", "block"), ("a.com/x", "/", "block"), ("a.com", "x", "block"), ("a.com", "/", "maybe")])
def test_entries_that_cannot_fit_fail(spark, entry):
    with pytest.raises(Exception, match="Not an entry"):
        urls.listed_files(urls.entry_table(spark, [entry]))


def test_torn_entries_fail(spark):
    torn = [("a.com", "/", "block"), ("a.com", "/", "allow")]
    with pytest.raises(Exception, match="Both allowed and blocked"):
        urls.listed_files(urls.entry_table(spark, torn))
    assert urls.listed_files(urls.entry_table(spark, torn[:1], torn[1:]))[2] == 5


def test_no_text_is_lost_where_ids_repeat(spark):
    """An id with two texts, one of which has a near copy; the same row twice; names that helpers might use."""
    long = " ".join(f"word{i}" for i in range(60))
    rows = [(1, "quite another text of its own kind"), (1, long), (3, long + " more"), (4, "alone here in this row"), (4, "alone here in this row"), (None, long)]
    docs = cluttered(spark.createDataFrame(rows, "doc_id long, text string")).withColumns({"__n": F.lit(1), "_source": F.lit(2)})
    found = neardup.deduplicated(docs)
    assert found.columns == docs.columns
    texts = Counter((r["doc_id"], r["text"]) for r in found.collect())
    assert texts.pop((1, long), 0) + texts.pop((3, long + " more"), 0) == 1
    assert texts == {rows[0]: 1, rows[3]: 1, rows[5]: 1}
    once = docs.filter("doc_id = 3 OR text LIKE 'alone%'").dropDuplicates(["doc_id"])
    assert neardup.deduplicated(once).count() == 2
