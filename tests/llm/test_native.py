"""Licences, exact dedup, URL rules, chat formatting and mixing: defined cases and brute force."""

import hashlib
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidewater.llm import chat_format, exact_dedup, license_scan, mix_sources, url_filter

DOC = "doc_id long, text string, lang string, source string, n_chars long, keep_id string, KEPT int, norm string, gk int"


def rows_of(spark, rows, schema=DOC):
    width = len(schema.split(","))
    return spark.createDataFrame([tuple(r) + (None,) * (width - len(r)) for r in rows], schema)


LONG = "word " * 30_000
DOCS = [(7, "a  b\tc"), (3, "a b\nc"), (5, "a b c"), (9, None), (8, ""), (1, " "), (2, LONG), (4, LONG + "x"), (None, "q"),
        (None, "q"), (6, "r"), (6, "r"), (10, "a b  c "), (11, "a\u00a0b c")]


def normal(t):
    return re.sub(r"[\x20\x09-\x0D]+", " ", t or "")


@pytest.mark.parametrize("cap", [256, 1])
def test_exact_dedup_against_brute_force(spark, cap):
    got = exact_dedup.exact_dedup(rows_of(spark, DOCS), cap_least=cap)
    assert {"keep_id", "group_size", "kept", "text_sha256", "norm", "gk"} <= set(got.columns)
    assert len([c for c in got.columns if c.lower() == "kept"]) == 1
    groups = {}
    for i, t in DOCS:
        groups.setdefault(normal(t), []).append(i)
    out = got.collect()
    assert len(out) == len(DOCS)
    kept = Counter()
    for r in out:
        ids = groups[normal(r.text)]
        assert r.group_size == len(ids)
        assert r.keep_id == min((i for i in ids if i is not None), default=None)
        assert r.text_sha256 == hashlib.sha256(normal(r.text).encode()).hexdigest()
        if r.kept:
            kept[normal(r.text)] += 1
            assert r.doc_id == r.keep_id
    assert kept == Counter({t: 1 for t in groups})


def test_exact_dedup_one_huge_group_is_split(spark):
    docs = spark.range(6000).selectExpr("id AS doc_id", "if(id % 3 = 0, 'same  text', concat('t', id)) AS text")
    out = exact_dedup.exact_dedup(docs, cap_least=50)
    r = out.where("group_size > 1").agg({"group_size": "max", "keep_id": "max", "doc_id": "count"}).first()
    assert sorted(r) == [0, 2000, 2000]
    assert out.where("kept").count() == 4001


def test_copies_without_an_id_are_spread(spark, monkeypatch):
    """A third of the rows are one text without an id, another third one text with one id."""
    rows = [(None, "the same")] * 2000 + [(7, "that  one")] * 2000 + [(100 + i, f"text {i}") for i in range(2000)]
    docs = rows_of(spark, rows).repartition(5)
    tables, write = {}, exact_dedup.written
    monkeypatch.setattr(exact_dedup, "written", lambda df, name: tables.setdefault(name, write(df, name)))
    out = exact_dedup.exact_dedup(docs, cap_least=100)
    got = Counter((r.doc_id, r.keep_id, r.group_size, r.kept) for r in out.collect() if r.doc_id is None or r.doc_id == 7)
    assert got == {(None, None, 2000, True): 1, (None, None, 2000, False): 1999, (7, 7, 2000, True): 1, (7, 7, 2000, False): 1999}
    assert sum(r.kept for r in out.collect()) == 2002
    runs = [r.run_size for r in tables["dedup-runs"].collect()]
    assert len(runs) == 4000 and max(runs) < 300


@pytest.mark.parametrize("op", [lambda d: exact_dedup.exact_dedup(d), lambda d: mix_sources.mix_sources(d),
                                lambda d: mix_sources.mixed_documents(d)])
def test_empty_documents(spark, op):
    assert op(rows_of(spark, [])).collect() == []


URLS = [None, "", "no scheme", "http://", "https://A.Example.NET/en/x?y#z", "http://example.net/de/", "http://net", "http://net/",
        "http://a.b.org/fr/q", "http://org.evil/fr/", "http://xnet/", "http://example.com/de/", "ftp://EXAMPLE.COM/de",
        "http://m.example.com/de/a?b", "http://example.net?q=/en/", "http://İ.example.net/en/", "http://a..net/x", "x://net/#/a"]


def judged(url, rules):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fit = [(len(h + p), len(h), h + p, v) for h, p, v in rules
           if (host == h or host.endswith("." + h)) and path.startswith(p)]
    best = max(fit, default=(0, 0, None, "allow"))
    return host, path, best[2], best[3]


def test_url_rules_against_brute_force(spark):
    rules = url_filter.RULES + [("b.org", "/", "block"), ("net", "/en/very/long/path/", "block"), ("example.net", "/", "allow")]
    urls = URLS + ["http://example.net/en/very/long/path/x", "http://a.b.org/fr/", "http://b.org/zz"]
    pages = spark.createDataFrame([(i, u, "k", 1, "h", "r") for i, u in enumerate(urls + urls[:3])],
                                  "page_id long, url string, key string, stack int, host string, Rule string")
    r = spark.createDataFrame(rules, "host string, path string, verdict string")
    out = url_filter.judge_urls(pages, r)
    assert out.count() == len(urls) + 3
    for row in out.collect():
        assert (row.host, row.path, row.rule, row.verdict) == judged(row.url, rules), row.url
    assert url_filter.judge_urls(pages.limit(0), r).collect() == []
    assert {x.verdict for x in url_filter.judge_urls(pages, r.limit(0)).collect()} == {"allow"}


def test_many_nested_rules_over_many_partitions(spark):
    """Thousands of nested rule hosts and a host with half of the URLs, against brute force."""
    rng = random.Random(6)
    names = [".".join(rng.choice("abc") for _ in range(rng.randrange(1, 7))) for _ in range(3000)]
    rules = list({(h, p): (h, p, v) for h, p, v in ((rng.choice(names), rng.choice(["", "/", "/x", "/x/y"]), rng.choice(["allow", "block"]))
                                                 for _ in range(2000))}.values())
    urls = [f"http://{rng.choice(names)}{rng.choice(['', '/', '/x', '/x/yz', '/q'])}" for _ in range(600)] + ["http://a.b.c/x/y"] * 600
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").repartition(3)
    r = spark.createDataFrame(rules, "host string, path string, verdict string").repartition(5)
    by_host = {}
    for rule in rules:
        by_host.setdefault(rule[0], []).append(rule)
    for row in url_filter.judge_urls(pages, r).collect():
        host = row.url.split("://")[1].split("/")[0].split(".")
        near = [x for i in range(len(host)) for x in by_host.get(".".join(host[i:]), [])]
        assert (row.host, row.path, row.rule, row.verdict) == judged(row.url, near), row.url


def test_rules_go_to_few_partitions(spark):
    hosts = url_filter.rule_hosts(spark.range(20_000).select(F.concat(F.lit("h"), "id", F.lit(".example.net")).alias("host"),
                                                             F.lit("/").alias("path"), F.lit("block").alias("verdict")))
    placed = hosts.repartitionByRange(32, "key").withColumn("pid", F.spark_partition_id())
    assert url_filter.borders(placed, 32, 3).count() <= 32 * 3


def chats(spark, rows):
    return spark.createDataFrame([(*r, 1, "x") for r in rows],
                                 "conv_id long, turn int, role string, text string, n int, part string")


@pytest.mark.parametrize("part", [4096, 2, 1])
def test_snapshots_collapse(spark, part):
    rows = [(1, 0, "user", "hi"), (1, 1, "bot", "yo"), (2, 0, "user", "hi"), (3, 0, "user", "hi"), (3, 1, "bot", "yo"),
            (3, 2, "user", "ok"), (4, 0, "user", "hi"), (4, 1, "bot", "yo"), (4, 2, "user", "ok"),
            (5, 5, "user", "hi"), (5, 6, "bot", "other"), (6, 0, None, None), (6, 0, None, None), (7, None, "user", "<|x|>"),
            (None, 0, "user", "lost"), (8, 0, "user", "tie b"), (8, 0, "user", "tie a"), (9, 0, "user", "z" * 200_000)]
    out = chat_format.format_chats(chats(spark, rows), part)
    text = {}
    for r in sorted(out.collect(), key=lambda r: r.part):
        text.setdefault(r.conv_id, [r.n_turns, r.copies, ""])[2] += r.text
    assert set(text) == {3, 5, 6, 7, 8, 9, None}
    assert text[3] == [3, 2, "<|user|>\nhi\n<|end|>\n<|bot|>\nyo\n<|end|>\n<|user|>\nok\n<|end|>\n"]
    assert text[5][:2] == [2, 1] and text[6] == [1, 1, "<||>\n\n<|end|>\n"]
    assert text[7][2] == "<|user|>\n< |x|>\n<|end|>\n"
    assert text[8][2].index("tie a") < text[8][2].index("tie b")
    assert len(text[9][2]) > 200_000


def test_one_conversation_of_a_third_of_the_rows_is_rendered_in_parts(spark):
    lost = [(None, None if i % 2 else 3, "user", f"t{i:04}") for i in range(1000)]
    rows = lost + [(i, 0, "user", f"own {i}") for i in range(2000)] + lost[:10]
    out = chat_format.format_chats(chats(spark, rows), 64).where("conv_id IS NULL").orderBy("part").collect()
    assert [r.part for r in out] == list(range(16)) and {r.n_turns for r in out} == {1000}
    assert [r.text.count("<|end|>") for r in out] == [64] * 15 + [40]
    wanted = sorted(lost, key=lambda r: (r[1] is not None, r[3]))
    assert "".join(r.text for r in out) == "".join(f"<|user|>\n{r[3]}\n<|end|>\n" for r in wanted)
    turns = chat_format.rolling_turns(chats(spark, rows), 64)
    assert sorted(r.pos for r in turns.where("conv_id IS NULL").collect()) == list(range(1, 1001))


def test_parts_are_bounded_in_bytes(spark):
    """A third of the rows are turns of 1 MB in one conversation: no part outgrows its weight by more than a turn."""
    turns = [(1, i, "user", str(i % 10) * 1_000_000) for i in range(40)] + [(2 + i, 0, "user", f"own {i}") for i in range(80)]
    out = chat_format.format_chats(chats(spark, turns), 1024).orderBy("conv_id", "part").collect()
    long = [r for r in out if r.conv_id == 1]
    assert len(long) == 10 and max(len(r.text) for r in long) < 1024 * 4096 + 1_100_000
    assert "".join(r.text for r in long) == "".join(f"<|user|>\n{t[3]}\n<|end|>\n" for t in turns[:40])
    small = chat_format.format_chats(chats(spark, turns[:3]), 1).orderBy("part").collect()
    assert [r.text.count("<|end|>") for r in small] == [1, 1, 1]


def test_no_conversations(spark):
    assert chat_format.format_chats(chats(spark, [])).collect() == []


def targets(sizes, weights=(5, 2, 1)):
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    out, open_ = {}, set(names)
    while open_:
        left = sum(sizes.values()) - sum(out.values())
        share = {s: left * w[s] / sum(w[x] for x in open_) for s in open_}
        over = {s for s in open_ if share[s] > 3 * sizes[s]}
        if not over:
            return out | share
        out |= {s: 3.0 * sizes[s] for s in over}
        open_ -= over
    return out


def test_rows_without_an_id_spread_over_ranges(spark):
    docs = rows_of(spark, [(None, f"text number {i}", "en", "a") for i in range(3000)])
    keys = docs.select(mix_sources.random_key(F.col("doc_id"), F.col("text"), "mix").alias("k")).withColumn("rng", F.shiftright("k", 60 - 5))
    sizes = [r["count"] for r in keys.groupBy("rng").count().collect()]
    assert len(sizes) == 32 and max(sizes) < 200
    out = mix_sources.mix_sources(docs, range_rows=64).collect()
    assert sum(r.taken for r in out) == 9000 and {r.taken for r in out} == {3}


def test_mix_meets_targets(spark):
    rows = [(i, "w " * (i % 7), "en", ["big", "mid", "z", None, "A"][0 if i % 3 else i % 5]) for i in range(900)]
    rows += [(2000, None, "en", "only null"), (2001, "x " * 40_000, "en", "long"), (2002, "", "en", "big"), (None, "a b", "en", "mid")]
    docs = rows_of(spark, rows)
    out = mix_sources.mix_sources(docs, range_rows=16).collect()
    again = mix_sources.mix_sources(docs.repartition(5), range_rows=400).collect()
    assert sorted(map(str, out)) == sorted(map(str, again))
    sizes, taken = Counter(), Counter()
    for r in out:
        sizes[r.source] += r.size
        taken[r.source] += r.taken
        assert 0 <= r.taken <= 3 * r.size
    want = targets(sizes)
    for r in out:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source])
    for s in sizes:
        assert abs(taken[s] - want[s]) <= 1
    mixed = Counter()
    for r in mix_sources.mixed_documents(docs, range_rows=16).collect():
        mixed[r.source] += len((r.text or "").split())
    assert {s: n for s, n in taken.items() if n} == dict(mixed)


def test_licences(spark):
    lines = {1: ("MIT", "Some text\nReleased under the MIT License.\nmore"), 2: ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
             3: ("CC-BY-NC-4.0", "x\r\nlicensed under CC BY-NC 4.0"), 4: ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
             5: (None, "the license of the software is a public work of the people"), 6: (None, None), 7: (None, ""), 8: (None, "\n \n"),
             9: (None, "plain words " * 20_000)}
    corpus = [(100 + i, f"the word {i} of a story about {i * 7} things and places\nsecond line {i} in it") for i in range(300)]
    rows = [(i, t) for i, (_, t) in lines.items()] + corpus + [(1, "Released under the MIT License."), (None, None)]
    docs = rows_of(spark, rows)
    model = license_scan.train(docs)
    got = {r.doc_id: r for r in license_scan.scan(docs, model).collect()}
    assert len(got) == len({i for i, _ in rows})
    for i, (family, _) in lines.items():
        assert got[i].family == family and got[i].families == ([family] if family else []), i
    assert got[1].n_licences == 2 and got[6].n_paragraphs == 0 and got[8].n_paragraphs == 0
    assert not any(got[i].n_licences for i, _ in corpus)
    assert license_scan.scan(rows_of(spark, []), model).collect() == []


WRAPPED = {
    "MIT": """Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
to use, copy, modify, merge, publish, distribute, sublicense, and/or sell""",
    "GPL-3.0": """ * This program is free software: you can redistribute it and/or modify
 * it under the terms of the GNU General Public License as published by
 * the Free Software Foundation, either version 3 of the License, or
 * (at your option) any later version.""",
    "GPL-2.0": """# This program is free software; you can redistribute it and/or
# modify it under the terms of the GNU General Public License version 2
# as published by the Free Software Foundation.""",
    "LGPL": """This library is free software; you can redistribute it and/or
modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation; either
version 2.1 of the License, or (at your option) any later version.""",
    "BSD": """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions
are met:""",
}


RELATIVES = {
    "AGPL-3.0": """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU Affero General Public License as published
by the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.""",
    "GPL-2.0": """This program is free software; you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation; either version 2 of the License, or
(at your option) any later version.""",
    "GPL-2.0 ": "GNU General Public License, version 2.",
    "LGPL": """This library is free software: you can redistribute it and/or
modify it under the terms of the GNU Lesser General Public License as
published by the Free Software Foundation, either version 3 of the
License, or (at your option) any later version.""",
    "CC-BY-ND-4.0": "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International\nLicense.",
    "CC-BY-NC-SA-4.0": "This work is licensed under a Creative Commons Attribution-NonCommercial-ShareAlike 4.0\nInternational License.",
    "CC-BY-3.0": "This work is licensed under a Creative Commons Attribution 3.0 Unported\nLicense.",
    "BSD": """Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:""",
}


def stories():
    return [(1000 + i, f"the word {i} of a story about {i * 7} things and places\nsecond line {i} in it") for i in range(300)]


def test_relatives_are_never_taken_for_each_other(spark):
    """Notices of related families in one line and wrapped, every template as a line, and versions nobody knows."""
    names = list(RELATIVES)
    rows = [(i, RELATIVES[f].replace("\n", " ")) for i, f in enumerate(names)] + [(100 + i, f"x\n{RELATIVES[f]}\ny") for i, f in enumerate(names)]
    rows += [(200 + i, t) for i, (_, t) in enumerate(license_scan.TEMPLATES)]
    rows += [(500, "This work is licensed under a Creative Commons Attribution 2.5 Generic License."), (501, "Licensed under CC BY 1.0."),
             (502, "This work is licensed under the GNU General Public License."), (503, "This work is licensed under the GNU Affero License, version 9.")]
    docs = rows_of(spark, rows + stories())
    got = {r.doc_id: r for r in license_scan.scan(docs, license_scan.train(docs)).collect()}
    for i, f in enumerate(names):
        assert got[i].family in (f.strip(), None) and got[100 + i].family in (f.strip(), None), (f, got[i], got[100 + i])
    own = sum(got[i].family == f.strip() for i, f in enumerate(names)) + sum(got[100 + i].family == f.strip() for i, f in enumerate(names))
    assert own >= 14, own
    for i, (f, t) in enumerate(license_scan.TEMPLATES):
        assert got[200 + i].family == f, (t, got[200 + i])
    assert all(got[i].family is None for i in range(500, 504)), [got[i] for i in range(500, 504)]


def test_confirmation_against_a_plain_recount(spark):
    docs = rows_of(spark, [(i, t) for i, (_, t) in enumerate(license_scan.TEMPLATES)] + stories())
    model = license_scan.train(docs)
    grams = lambda t: [f"{a} {b}" for w in [re.findall(r"[^\W_]+", t.lower())] for a, b in zip(w, w[1:])]
    templates = [(f, set(grams(t))) for f, t in license_scan.TEMPLATES]
    texts = [t for t in [*RELATIVES.values(), *WRAPPED.values(), *[t for _, t in license_scan.TEMPLATES]]]
    lines = spark.createDataFrame([(i, t.replace("\n", " ")) for i, t in enumerate(texts)], "i int, t string")
    lines = lines.withColumn("words", license_scan.words_of(F.col("t")))
    for r in model.compared(lines, "i", "t").collect():
        have = set(grams(r.t))
        share = lambda d: 0.5 if not d else len(d & have) / len(d)  # noqa: E731, B023
        telling = lambda d: {p for p in d if license_scan.TELLING & set(p.split())}
        best = max(((len(t & have) / len(t) >= (0.6 if len(t) > 12 else 0.7) and all(
            share(telling(t - u)) > share(telling(u - t)) for g, u in templates if g != f and len(t & u) >= 0.5 * min(len(t), len(u))),
            len(t & have) / len(t)) for f, t in templates if f == r.family), default=(False, None))
        assert (r.confirmed, r.similarity) == best, r


def test_licences_learn_from_every_line(spark):
    """One text of many has lines of licence words in other orders: all of them teach the unknown class and its cut."""
    rng = random.Random(3)
    words = sorted({w for _, t in license_scan.TEMPLATES for w in re.findall(r"[^\W_]+", t.lower())})
    odd = [" ".join(rng.sample(words, 14)) for _ in range(300)]
    rows = [(i, "\n".join(f"line {j} of the story {i} about {i * j} things" for j in range(20))) for i in range(40)]
    rows += [(100, "\n".join(odd)), (101, "Released under the MIT License."), (102, WRAPPED["MIT"])]
    docs = rows_of(spark, rows)
    got = {r.doc_id: r for r in license_scan.scan(docs, license_scan.train(docs)).collect()}
    assert (got[101].families, got[102].families) == (["MIT"], ["MIT"])
    assert sum(r.n_paragraphs for r in got.values()) == 40 * 20 + 300 + 1 + 4
    assert sum(r.n_unconfirmed for i, r in got.items() if i < 101) <= 2


def test_every_line_is_an_example_but_those_of_notices(spark):
    texts = ["a plain line\nand one more\n!!\n", WRAPPED["GPL-3.0"] + "\nA story\nof plain words", "x\nReleased under the MIT License.", None, " \n"]
    known = [[f"{a} {b}" for a, b in zip(w, w[1:])] for w in (re.findall(r"[^\W_]+", t.lower()) for _, t in license_scan.TEMPLATES)]
    reach = max(map(len, known)) + 1
    got = license_scan.unknown_lines(rows_of(spark, list(enumerate(texts))), "doc_id", "text", known, reach, ["a", "of", "one more", "story"])
    assert sorted(sorted(r.grams) for r in got.collect()) == sorted([["a"], ["one more"], [], ["a", "story"], ["of"], []])


def test_wrapped_licences(spark):
    corpus = [(100 + i, f"the word {i} of a story about {i * 7} things and places\nsecond line {i} in it") for i in range(300)]
    families = list(WRAPPED)
    rows = [(i, f"A story begins.\n{WRAPPED[f]}\n\nAnd it ends\nhere.") for i, f in enumerate(families)]
    rows += [(10, WRAPPED["MIT"] + "\n" + WRAPPED["LGPL"]), (11, "\n".join(WRAPPED["GPL-3.0"].replace("*", "").split())),
             (12, WRAPPED["BSD"] + "\ntext between\nReleased under the MIT License.\n" + WRAPPED["BSD"]),
             (None, WRAPPED["MIT"]), (None, WRAPPED["GPL-2.0"])]
    docs = rows_of(spark, rows + corpus)
    got = {r.doc_id: r for r in license_scan.scan(docs, license_scan.train(docs)).collect()}
    for i, f in enumerate(families):
        assert (got[i].families, got[i].n_licences) == ([f], 1), f
        assert got[i].similarity > 0.9
    assert (got[10].families, got[10].n_licences) == (["LGPL", "MIT"], 2)
    assert (got[11].families, got[11].n_licences) == (["GPL-3.0"], 1)
    assert (got[12].families, got[12].n_licences) == (["BSD", "MIT"], 3)
    assert (got[None].families, got[None].n_licences) == (["GPL-2.0", "MIT"], 2)
    assert not any(got[i].n_licences for i, _ in corpus)


def test_licences_read_the_texts_once(spark):
    """Training and scan share one table of lines; the texts are not read again."""
    rows = [(i, f"the word {i} of a story\nsecond line {i} in it") for i in range(60)]
    rows += [(100, WRAPPED["MIT"]), (101, "Released under the MIT License."), (102, None), (102, "a\nb")]
    docs = rows_of(spark, rows)
    read = license_scan.read_lines(docs)
    assert read.where("i is not null").count() == 120 + len(WRAPPED["MIT"].split("\n")) + 1 + 2
    assert {r.doc_id for r in read.where("whole is not null").collect()} == {100}
    gone = docs.withColumn("text", F.raise_error(F.lit("read again")).cast("string"))
    model = license_scan.train(gone, read=read)
    got = {r.doc_id: r for r in license_scan.scan(gone, model, read=read).collect()}
    assert (got[100].families, got[101].families, got[102].n_paragraphs) == (["MIT"], ["MIT"], 2)
    assert got == {r.doc_id: r for r in license_scan.scan(docs, model).collect()}
