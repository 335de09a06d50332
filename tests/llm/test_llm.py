"""The text operators against DuckDB, brute force, the tokenizers' own answers and held-out labels."""

import hashlib
import itertools
import random
import textwrap
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
from candlewick.llm import boosting, decontaminate, licenses, neardup, packing, perplexity, pii, repeats, statistics, tokens, toxicity
from candlewick.llm.charmodel import gram_counts
from candlewick.llm.common import read
from candlewick.llm.oracles import ORACLES
from candlewick.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
SENTENCE = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon "


@pytest.fixture(scope="module")
def docs(spark):
    return read(spark, SF, "documents")


@pytest.fixture(scope="module")
def texts(docs):
    return {r["doc_id"]: r["text"] for r in docs.collect()}


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and very long texts, ties, repeated rows and columns named as the operators' own."""
    long = " ".join(random.Random(1).choice(["red", "blue", "a1", "x@y.zz", "10.0.0.1", "\n"]) for _ in range(60_000))
    rows = [
        (1, None, "en", "k"), (2, "", None, None), (3, "  \n\n ", "en", "k"), (4, "one", "en", "k"), (4, "one", "en", "k"),
        (5, SENTENCE * 5, "en", "k"), (6, SENTENCE * 5, "en", "k"), (7, long, "xx", "k"), (8, "日本語 é 😀 " * 30, None, "k"),
        (9, "aaaa" * 100, "en", "k"), (None, "no id here", "en", "k"), (10, SENTENCE * 4 + "end", "en", "k"),
    ]
    made = spark.createDataFrame(rows, "doc_id long, text string, lang string, key string")
    names = ("h", "band", "findings", "score", "class", "n", "quality", "toxic", "item_id")
    for name in names:
        made = made.withColumn(name, made["key"])
    return made


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (4, 0, 1), (5, 1, None), (5, None, 0), (None, 1, 1), (9, 0, 0)], "doc_id long, quality int, toxic int")


def operators(spark, labels):
    items = spark.createDataFrame([(1, SENTENCE), (2, None), (3, ""), (4, "no id"), (4, "one")], "item_id long, text string")
    path = public_tokenizers.path
    return {
        "repeats": repeats.repeated_spans,
        "pii": pii.digests,
        "redacted": pii.redacted,
        "toxicity": lambda d: toxicity.score(d, toxicity.learnt(d, labels)),
        "without_toxic": lambda d: toxicity.without_toxic(d, toxicity.learnt(d, labels)),
        "neardup": neardup.near_duplicates,
        "deduplicated": neardup.deduplicated,
        "perplexity": perplexity.quality_rules,
        "boosting": lambda d: boosting.score(d, boosting.fitted(d, labels)),
        "decontaminate": lambda d: decontaminate.contaminated(d, items),
        "decontaminated": lambda d: decontaminate.decontaminated(d, items),
        "licenses": licenses.license_blocks,
        "packing": lambda d: packing.pack(d, path("word_bpe_49k.json")),
        "tokens": lambda d: tokens.token_counts(d, path("piece_bpe_32k.model")),
        "prefixes": lambda d: tokens.prefix_table(d, path("piece_bpe_32k.model")),
    }


NAMES = (
    "repeats pii redacted toxicity without_toxic neardup deduplicated perplexity boosting decontaminate decontaminated "
    "licenses packing tokens prefixes"
).split()


@pytest.mark.parametrize("name", NAMES)
def test_odd_rows_and_empty_tables(spark, odd, labels, name):
    run = operators(spark, labels)[name]
    found = run(odd).collect()
    n = {"decontaminate": None, "licenses": 0, "packing": None, "without_toxic": None, "deduplicated": 9, "decontaminated": 7}.get(name, 12)
    assert n is None or len(found) == n
    if name == "decontaminate":
        assert {(r["doc_id"], r["item_id"]) for r in found} == {(4, 4), (5, 1), (6, 1), (10, 1)}
    if name in ("redacted", "without_toxic", "deduplicated", "decontaminated"):
        assert run(odd).columns == odd.columns
    assert run(odd.limit(0)).collect() == []
    nothing = {n: f for n, f in operators(spark, labels.limit(0)).items() if n in ("toxicity", "boosting")}
    if name in nothing:
        assert len(nothing[name](odd).collect()) == 12


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_duckdb(spark, name):
    run = QUERIES[name]
    con = duckdb.connect()
    for table in ("documents", "benchmark", "labels", "pages"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    want = con.execute(ORACLES[name]).df()
    found = run(spark, SF).toPandas()[want.columns]
    assert sorted(map(tuple, found.astype(str).to_numpy())) == sorted(map(tuple, want.astype(str).to_numpy()))


def test_spans_in_planted_text(spark):
    text = "é a@b.co a@b.c_d@e.f 1.2.3.4.5.6.7.256 or 4111 1111 1111 1111 and 4111 1111 1111 1112, +49 (30) 123-4567. IBAN DE89370400440532013000"
    row = pii.digests(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    spans = {(s["kind"], s["value"]) for s in row["findings"]}
    assert {("email", "a@b.co"), ("email", "a@b.c"), ("email", "_d@e.f"), ("ip", "1.2.3.4"), ("card", "4111 1111 1111 1111")} <= spans
    assert {("phone", "+49 (30) 123-4567"), ("iban", "DE89370400440532013000")} <= spans and (row["n_card"], row["n_ip"]) == (1, 1)
    assert all(text[s["start"] : s["end"]] == s["value"] for s in row["findings"])
    clean = pii.redacted(spark.createDataFrame([(1, "to a@b.co now")], "doc_id long, text string")).first()
    assert clean["text"] == "to [EMAIL] now"


def brute_repeats(texts):
    data = [(t or "").encode() for t in texts]
    times = Counter(b[i : i + 200] for b in data for i in range(len(b) - 199))
    for b in data:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - 199):
            if times[b[i : i + 200]] > 1:
                gone[i : i + 200] = True
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        runs = sum(gone[i] and not (i and gone[i - 1]) for i in range(len(b)))
        yield len(b), int(gone.sum()), int(runs), hashlib.sha256(kept).hexdigest()


@pytest.mark.parametrize("group", [1, 4096])
def test_repeats_match_brute_force(spark, docs, texts, group, monkeypatch):
    monkeypatch.setattr(repeats, "GROUP", group)
    found = {r["doc_id"]: tuple(r[1:5]) for r in repeats.repeated_spans(docs).collect()}
    assert found == dict(zip(texts, brute_repeats(texts.values()), strict=True))


def test_repeats_of_short_periods_and_chunks(spark, monkeypatch):
    monkeypatch.setattr(repeats, "CHUNK", 512)
    rnd = random.Random(3)
    noise = ["".join(rnd.choice("abcdefgh ") for _ in range(1500)) for _ in range(4)]
    made = ["a" * 199, "a" * 200, "a" * 450, "ab" * 300, noise[0], noise[0][:700] + noise[1], noise[2] + noise[1][300:501], noise[3] * 2, None]
    rows = spark.createDataFrame(list(enumerate(made)), "doc_id long, text string")
    found = [tuple(r[1:5]) for r in repeats.repeated_spans(rows).orderBy("doc_id").collect()]
    assert found == list(brute_repeats(made))


@pytest.mark.parametrize("small", [1, 50])
def test_near_duplicates_match_brute_force(spark, docs, texts, small, monkeypatch):
    monkeypatch.setattr(neardup, "SMALL", small)
    idf = neardup.inverse_shares(docs)
    sets = {d: (h, n * idf[neardup.features(h)]) for d, (h, n) in zip(texts, neardup.shingled(list(texts.values())), strict=True)}
    parent = {d: d for d in texts}

    def top(d):
        while parent[d] != d:
            d = parent[d]
        return d

    for a, b in itertools.combinations(texts, 2):
        if texts[a] == texts[b] or neardup.similarity(sets[a], sets[b]) >= neardup.THRESHOLD:
            lo, hi = sorted((top(a), top(b)))
            parent[hi] = lo
    found = {r["doc_id"]: r["class_id"] for r in neardup.near_duplicates(docs).collect()}
    assert found == {d: top(d) for d in texts} and len(set(found.values())) < len(found)


def test_draws_agree_as_weighted_sets_do():
    rnd = np.random.default_rng(5)
    h = rnd.integers(0, 2**63, 400).astype(np.uint64)
    w = rnd.uniform(0.5, 8, 400)
    v = w * np.where(rnd.random(400) < 0.4, rnd.uniform(0.2, 1, 400), 1)
    want = np.minimum(v, w).sum() / np.maximum(v, w).sum()
    agree = (neardup.sampled(h, w, neardup.MORE_SEEDS) == neardup.sampled(h, v, neardup.MORE_SEEDS)).mean()
    assert abs(agree - want) < 0.08




def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 12)] + [(100, 90), (100, 95), (200, 201)]
    found = {r["id"]: r["class"] for r in neardup.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert all(found[i] == 0 for i in range(1, 13)) and found[100] == found[95] == 90 and found[201] == 200


def test_cues_find_held_out_toxic_documents(spark):
    sf = SF.replace("0.001", "0.1")
    found = toxicity.op3_toxicity(spark, sf).join(read(spark, sf, "labels"), "doc_id").where("held_out AND toxic IS NOT NULL").toPandas()
    toxic, clean = found[found.toxic == 1], found[found.toxic == 0]
    assert (toxic.predicted == 1).mean() > 0.9 and (clean.predicted == 0).mean() > 0.97


def test_obfuscated_words_are_restored(docs):
    counts = gram_counts(docs, order=3, fold=True).toPandas()
    channel = toxicity.Channel(perplexity.KneserNey(counts["gram"].to_numpy(), counts["n"].to_numpy(), 3))
    odd = {"1d10t": "idiot", "i.d.i.o.t": "idiot", "$tupid": "stupid", "idiooot": "idiot", "STUPID!!": "stupid", "the&&&": "the"}
    assert {w: channel.restored(w) for w in odd} == odd
    assert "idiot" in toxicity.tokens("an i d i o t here")


def test_marks_at_ends_breaks_and_short_words_are_restored(spark):
    rows = spark.createDataFrame([("you are a loser and an idiot scum worthless one",)] * 50, "text string")
    counts = gram_counts(rows, order=3, fold=True).toPandas()
    channel = toxicity.Channel(perplexity.KneserNey(counts["gram"].to_numpy(), counts["n"].to_numpy(), 3))
    odd = {"idio+": "idiot", "worthle$$": "worthless", "$$cum$": "scum", "loser!!!": "loser", "*you*": "you", "a!": "a"}
    assert {w: channel.restored(w) for w in odd} == odd
    for text, want in {"so a l o s e r": {"a", "loser"}, "so i d i o t s c u m": {"idiot", "scum"}}.items():
        assert want <= toxicity.text_features(text, channel)
    assert toxicity.text_features("you a", channel) == {"you", "a"}
    assert "idio*#2" not in toxicity.text_features("i d i o t s c u m", channel)


def test_trees_reject_held_out_junk(spark):
    sf = SF.replace("0.001", "0.1")
    found = boosting.op6_quality_classifier(spark, sf).join(read(spark, sf, "labels"), "doc_id").where("held_out").toPandas()
    assert (found.predicted == found.quality).mean() > 0.98 and found.score.between(0, 1).all()


def test_model_is_a_distribution_and_bands_keep_clean_documents(spark, docs):
    counts = gram_counts(docs).toPandas()
    model = perplexity.KneserNey(counts["gram"].to_numpy(), counts["n"].to_numpy())
    for context in (0, 5 << 12 | 3 << 6 | 1, 63 << 12 | 31 << 6 | 32):
        total = model.probability(np.arange(64, dtype=np.uint32) | np.uint32(context << 6), 4).sum()
        assert abs(total - 1) < 1e-6
    sf = SF.replace("0.001", "0.01")
    found = perplexity.op5_quality_rules(spark, sf).join(read(spark, sf, "labels"), "doc_id").where("NOT base_failed").toPandas()
    assert found[found.quality == 1].kept.mean() > 0.98 and found[found.quality == 0].kept.mean() < 0.1


def test_base_statistics_match_a_plain_reading(texts):
    import re

    for text in [*list(texts.values())[:60], "a b c a b c", "x y z\n\nq\nq\n \nq", "a a a a a a"]:
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        windows = Counter(zip(words, words[1:], words[2:], strict=False))
        twice = {i + k for i in range(len(words) - 2) for k in range(3) if windows[tuple(words[i : i + 3])] > 1}
        lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        assert statistics.base(text) == {
            "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
            "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(twice),
        }


def test_capitals_count_alike_at_all_sizes():
    at = statistics.FEATURES.index("upper_per_char")
    for word, share in {"ΑΒγδ ": 0.4, "Žluť ": 0.2, "ŁÓDŹ ": 0.8, "Œuvr ": 0.2, "İab🙂 ": 0.2, "𐐀bcd ": 0.2}.items():
        assert statistics.features(word * 10)[at] == statistics.features(word * 1000)[at] == share


def test_license_blocks_match_brute_force(spark):
    lines = [
        "Released under the MIT License.", "Licensed under CC BY-NC 4.0.", "Licensed under CC BY-ND 4.0.",
        "This work is licensed under the GNU General Public License, version 3.", "The license of her car was lost.",
        "This work is licensed under the GNU General Public License, version 9.", licenses.WORDINGS["Apache-2.0"][2].upper(),
    ]
    rows = spark.createDataFrame([(i, f"some words\n{line}\nmore") for i, line in enumerate(lines)], "doc_id long, text string")
    found = {r["doc_id"]: r["license"] for r in licenses.license_blocks(rows).collect()}
    assert found == {i: licenses.brute_force(line) for i, line in enumerate(lines)}
    assert [found[i] for i in range(7)] == ["MIT", "CC-BY-NC-4.0", None, "GPL-3.0", None, None, "Apache-2.0"]


@pytest.mark.parametrize("width", [30, 70, 75, 80])
def test_wrapped_wordings_match_brute_force_on_whole_texts(spark, width):
    wordings = [(name, w) for name, own in licenses.WORDINGS.items() for w in own]
    made = ["int x;\n" + textwrap.fill(w, width) + "\nint main()\n{\n}" for _, w in wordings]
    rows = spark.createDataFrame(list(enumerate(made)), "doc_id long, text string")
    found = sorted((r["doc_id"], r["line"], r["license"]) for r in licenses.license_blocks(rows).collect())
    assert found == [(i, 1, name) for i, (name, _) in enumerate(wordings)]
    assert [licenses.brute_force(t) for t in made] == [name for name, _ in wordings]


def test_blocks_have_all_their_licenses(spark):
    gpl2 = "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."
    lgpl3 = gpl2.replace("program", "library").replace("General", "Lesser General").replace("version 2", "version 3")
    made = ["Released under the MIT License.\nLicensed under the Apache License, Version 2.0.", textwrap.fill(gpl2, 75), textwrap.fill(lgpl3, 75)]
    every = [own[0] for own in licenses.WORDINGS.values()]
    rows = spark.createDataFrame(list(enumerate([*made, "\n".join(every)])), "doc_id long, text string")
    found = licenses.license_blocks(rows).collect()
    by_doc = [{r["license"] for r in found if r["doc_id"] == i} for i in range(4)]
    assert by_doc == [{"MIT", "Apache-2.0"}, {"GPL-2.0"}, {"LGPL-3.0"}, set(licenses.WORDINGS)]


def test_packing_is_an_exact_round_trip(docs, texts):
    from tokenizers import Tokenizer

    path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer, found = Tokenizer.from_file(path), packing.pack(docs, path).toPandas()
    for doc, own in found.sort_values("start").groupby("doc_id"):
        ids = np.array([*tokenizer.encode(texts[doc], add_special_tokens=False).ids, 2], "<u4").tobytes()
        assert b"".join(own.ids) == ids and (own.doc_tokens == len(ids) // 4).all()
        assert [zlib.crc32(i) for i in own.ids] == own.ids_crc32.tolist()
    for _, own in found.sort_values("offset").groupby("sequence_id"):
        assert own.offset.tolist() == [0, *own.length.cumsum()[:-1]] and own.length.sum() <= 4096
    used = found.groupby("sequence_id").length.sum()
    assert sum(0 if n & (n - 1) == 0 else 4096 - n for n in used) < 0.02 * used.sum()
    odd = "A. B, 'S. it's, É. e\u0301. Á, x<|endoftext|>, ., ,. a.. 日本. İ. Σ. ΟΔΟΣ, \u0958. ²."
    assert tokenizer.encode(odd, add_special_tokens=False).ids == list(np.frombuffer(packing.encoder(path).encode(odd), "<u4"))
    assert tokenizer.encode("a<|endoftext|>b\x1cc", add_special_tokens=False).ids == list(
        np.frombuffer(packing.encoder(path).encode("a<|endoftext|>b\x1cc"), "<u4")
    )


def test_token_counts_match_the_library_at_every_prefix(texts):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    library, own = sentencepiece.SentencePieceProcessor(model_file=path), tokens.counter(path)
    rnd = random.Random(2)
    odd = ["", " ", " a  b ", "▁x", "<s>a</s> <0x0A>", "日本 😀", "aaaa" * 80, "\x00\t"]
    odd += ["".join(rnd.choice("ab er\n▁ éthion 😀x1") for _ in range(40)) for _ in range(300)]
    for text in [*list(texts.values())[:50], *odd]:
        assert own.count(text) == len(library.encode(text))
    for text in odd[:60]:
        at = [len(library.encode(text[:i])) for i in range(len(text) + 1)]
        assert [own.at(text, i) for i in range(len(text) + 1)] == at
        assert own.cut(text, 9) == max(i for i, n in enumerate(at) if n <= 9)


def test_prefix_table_answers_budgets(spark):
    rows = spark.createDataFrame([(1, "one two three four")], "doc_id long, text string")
    table = tokens.prefix_table(rows, public_tokenizers.path("piece_bpe_32k.model"))
    got = table.select(tokens.count_at(7).alias("n"), tokens.fits(2).alias("chars")).first()
    assert (got["n"], got["chars"]) == (2, 7)


def test_prefix_table_is_exact_inside_units(spark):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    made = ["aGVsbG8gd29ybGQhIHRoaXM=", "日本語の文章です。😀中文", "internationalization of words", " a  b ", "x" * 250, ""]
    table = tokens.prefix_table(spark.createDataFrame(list(enumerate(made)), "doc_id long, text string"), path).orderBy("doc_id").cache()
    at = [[len(library.encode(t[:i])) for i in range(31)] for t in made]
    found = table.select(*[tokens.count_at(i).alias(f"n{i}") for i in range(31)]).collect()
    assert [list(r) for r in found] == at
    found = table.select(*[tokens.fits(b).alias(f"f{b}") for b in range(12)]).collect()
    want = [[max(i for i in range(len(t) + 1) if len(library.encode(t[:i])) <= b) for b in range(12)] for t in made]
    assert [list(r) for r in found] == want
    assert [[tokens.counter(path).cut(t, b) for b in range(12)] for t in made] == want


def test_pipeline_stages_keep_what_they_should(spark, texts):
    import corpus_pipeline as pipeline

    docs = read(spark, SF, "documents")
    outs = []
    for name, stage in pipeline.STAGES:
        outs.append(pipeline.stored(stage(spark, docs, SF), name))
        docs = outs[-1]
    cues = toxicity.learnt(read(spark, SF, "documents"), read(spark, SF, "labels"))
    clean = {d for d, t in texts.items() if cues.score(t) < toxicity.THRESHOLD}
    ids = [{r["doc_id"] for r in out.select("doc_id").collect()} for out in outs]
    assert ids[0] == clean and ids[1] <= ids[0] and len({texts[d] for d in ids[0]}) >= len(ids[1])
    items = [r["text"] for r in read(spark, SF, "benchmark").collect()]
    assert ids[2] <= ids[1] and not any(i in texts[d] for d in ids[2] for i in items) and ids[3] == ids[2] == ids[4]
    assert all("@mail" not in r["text"] for r in outs[3].collect())
    final = pipeline.run(spark, SF)
    assert final.count() == outs[4].count()


def test_packing_words_match_the_library_for_every_kind_of_letter():
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    library = packing.tokenizer(path)
    chars = [chr(i) for i in range(0x600)]
    for text in (
        " ".join(chars),
        " ".join(f"a{c}b {c}C. d{c}, {c}. {c}" for c in chars),
        " ".join(f"{c.upper()}A, {c.lower()}a é{c}" for c in chars),
        "..., ., a., b.. C, ,. .\x1c a\x1d. it's IT'S. <|endoftext|>,",
    ):
        coded = packing.encoder(path)
        expected = library.encode(text, add_special_tokens=False).ids
        assert expected == list(np.frombuffer(coded.encode(text), "<u4"))
        assert expected == list(np.frombuffer(coded.encode(text), "<u4"))  # from memory


def test_packing_starts_anew_beyond_its_memory(monkeypatch):
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    monkeypatch.setattr(packing, "MEMO_WORDS", 3)
    coded = packing.encoder(path)
    for text in ("one two three four", "two five. six", "", "one two seven"):
        expected = packing.tokenizer(path).encode(text, add_special_tokens=False).ids
        assert expected == list(np.frombuffer(coded.encode(text), "<u4"))
