"""URL filter, licence scan and sharding against plain Python."""

import random
import re
import zlib

import duckdb
import pytest

from regspark.llm.licenses import BASE_PHRASES, TEMPLATES, scan_licenses
from regspark.llm.oracle import SQL
from regspark.llm.sharding import feistel_int, shard_rows
from regspark.llm.url_filter import Rule, build_cascade, judge_urls, listed_in, mostly_blocked_hosts

RULES = [Rule("org", "/", "allow"), Rule("example.org", "/es/", "block"), Rule("example.org", "/en/1", "block"),
         Rule("com", "/fr/", "allow"), Rule("com", "/de/", "block")]


def judged(url):
    m = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (m[1].translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")), m[2]) if m else ("", "")
    best = max(((len(r.key), r.key, r.verdict) for r in RULES if ("." + host).endswith("." + r.host) and path.startswith(r.path)), default=None)
    return host, path, best and best[1], best and best[2]


def test_urls_match_plain_rules(spark):
    rng = random.Random(1)
    hosts = ["Example.ORG", "a.example.org", "notexample.org", "x.com", "com", "org", "b.net", "a..com", "x.com:80", "u@x.org", ""]
    paths = ["", "/", "/es/1", "/es", "/en/1", "/en/185?x", "/fr/ä#t", "/de/", "?q=/de/", "#/fr/", "/ES/"]
    urls = [f"{rng.choice(['http', 'HTTPS'])}://{h}{p}" for h in hosts for p in paths] + [None, "", "no scheme", "://", "a://b://c.org/"]
    rows = list(enumerate(urls)) + [(None, "http://x.org/"), (3, urls[3])]
    pages = spark.createDataFrame([(i, u, "t") for i, u in rows], "page_id long, url string, rule string")
    score = {}
    for _, u in rows:
        host, _, rule, verdict = judged(u)
        if rule and host:
            score[host] = score.get(host, 0) + (1 if verdict == "block" else -1)
    bad = mostly_blocked_hosts(pages, RULES)
    assert {r.key for r in bad.collect()} == {h for h, s in score.items() if s > 0}
    got = sorted((tuple(r) for r in judge_urls(pages, RULES, bad).collect()), key=str)
    want = []
    for i, u in rows:
        host, path, rule, verdict = judged(u)
        want.append((i, host, path, rule, verdict or ("block" if score.get(host, 0) > 0 else "allow")))
    assert got == sorted(want, key=str)
    plain = judge_urls(pages.where("false"), RULES)
    assert plain.count() == 0 and plain.columns == ["page_id", "host", "path", "rule", "verdict"]
    assert {r.verdict for r in judge_urls(pages, []).collect()} == {"allow"}


def test_cascade_is_exact_over_its_universe_also_in_shards(spark, monkeypatch):
    import regspark.llm.url_filter as module

    keys = [f"k{i}" for i in range(3000)]
    listed = keys[::7]
    both = spark.createDataFrame([(k, k in set(listed)) for k in keys], "key string, listed boolean")
    cascade = build_cascade(both)
    assert len(cascade.levels) > 1  # false positives were met and encoded
    rows = spark.createDataFrame([(i, keys[i : i + 3]) for i in range(0, 3000, 3)], "i int, keys array<string>")
    for bits in (module.MAX_BITS, 2048):
        monkeypatch.setattr(module, "MAX_BITS", bits)
        got = listed_in(rows, spark.createDataFrame([(k,) for k in listed], "key string"), "hit").collect()
        assert sorted(k for r in got for k in r.hit) == sorted(listed)


def test_long_hosts_ask_for_few_keys(spark):
    from regspark.llm.url_filter import candidate_keys

    hosts = ["a." * 32_000 + "example.org", "." * 64_000, "x" * 64_000 + ".com", "a..com", "com", ""]
    rows = spark.createDataFrame([(h, "/de/1") for h in hosts], "host string, path string")
    got = rows.select(candidate_keys([(1, 1), (1, 4), (2, 4)]).alias("k")).collect()
    assert all(len(r.k) <= 4 for r in got)
    assert set(got[3].k) == {"a..com", "com/", "com/de/", ".com/de/"} and got[5].k == []
    assert {"org/", "org/de/", "example.org/de/", hosts[0]} == set(got[0].k)
    pages = spark.createDataFrame([(i, f"http://{h}/es/") for i, h in enumerate(hosts)], "page_id long, url string")
    assert {r.page_id: r.rule for r in judge_urls(pages, RULES).collect()} == {0: "example.org/es/", 1: None, 2: None, 3: None, 4: None, 5: None}


def test_a_level_of_false_positives_beyond_the_bound_is_split(spark, monkeypatch):
    import regspark.llm.url_filter as module

    monkeypatch.setattr(module, "MAX_BITS", 1024)
    keys = [f"k{i}" for i in range(12000)]
    rows = spark.createDataFrame([(i, keys[i : i + 3]) for i in range(0, 12000, 3)], "i int, keys array<string>")
    listed = keys[::300]  # one filter by their number; level 2 holds some 280 false positives
    both = spark.createDataFrame([(k, k in set(listed)) for k in keys], "key string, listed boolean")
    with pytest.raises(module.TooManyKeys):
        build_cascade(both)
    got = listed_in(rows, spark.createDataFrame([(k,) for k in listed], "key string"), "hit").collect()
    assert sorted(k for r in got for k in r.hit) == sorted(listed)


def words(text):
    low = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def test_license_base_and_method(spark):
    texts = [
        "Released under the MIT License.", "x UNDER-THE mit, license under the mit license", "Licensed under CC BY-NC 4.0.",
        "Licensed under the Apache License, Version 2.0.", "apache license version 20", "This work is licensed under the GNU General "
        "Public License, version 3.", "general public version license", "Permission is hereby granted, free of charge, to any person "
        "obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without "
        "restriction", "İ under the mit license Kelvin cc by nc", "ünder the mit license", "", None, " -- ", "cc by nc " * 50,
        "under the mit license " * 3 + "x " * 5000 + "apache license version 2",
    ]
    rows = list(enumerate(texts)) + [(None, "cc by nc"), (0, texts[0])]
    df = spark.createDataFrame([(i, t, "q", 1.0) for i, t in rows], "doc_id long, text string, labels string, score double")
    got = scan_licenses(df).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    for i, t in rows:
        w, places, labels = words(t), [], set()
        for phrase, label in BASE_PHRASES:
            p = phrase.split()
            for k in range(len(w) - len(p) + 1):
                if w[k : k + len(p)] == p:
                    places.append(k)
                    labels.add(label)
        r = by_id[i]
        assert (r.n_words, r.n_base, r.base_labels) == (len(w), len(places), ",".join(sorted(labels)))
        assert (r.first_word, r.last_word) == ((min(places), max(places)) if places else (None, None))
        assert labels <= set(r.labels.split(",")) and 0 <= r.score <= 1
    assert by_id[5].labels == "gpl-3" and by_id[7].labels == "mit" and by_id[6].labels == ""
    assert by_id[7].score > 0.9 and by_id[6].score == 0
    assert scan_licenses(df.where("false")).count() == 0


def test_license_scan_finds_every_notice_of_a_text(spark):
    by_start = {text.split()[0] + str(k): (label, text) for k, (label, text, _) in enumerate(TEMPLATES)}
    apache, gpl2 = by_start["you2"], by_start["gnu9"]
    mit = by_start["permission13"]
    assert (apache[0], gpl2[0], mit[0]) == ("apache-2", "gpl-2", "mit")
    rng = random.Random(8)
    picks = [TEMPLATES, TEMPLATES[::-1]] + [rng.sample(TEMPLATES, k) for k in (3, 4, 5, 5, 6, 8, 12) for _ in range(6)]
    notices = [[(label, text) for label, text, _ in pick] for pick in picks] + [[apache, gpl2, mit]]
    # common licence words in other texts, so that rarity differs between the templates' words
    texts = [" filler words between the parts ".join(text for _, text in part) for part in notices]
    common = [(1000 + k, "gnu general public license version lesser affero sharealike creative commons") for k in range(40)]
    df = spark.createDataFrame([*enumerate(texts), *common], "doc_id long, text string")
    got = {r.doc_id: set(r.labels.split(",")) for r in scan_licenses(df).collect()}
    for k, part in enumerate(notices):
        assert {label for label, _ in part} <= got[k], (k, {label for label, _ in part} - got[k])


def test_license_sql_and_scan_agree_on_texts_of_many_notices(spark, workdir):
    rng = random.Random(9)
    all_words = [w for _, text, _ in TEMPLATES for w in text.split()]
    texts = [" and ".join(text for _, text, _ in TEMPLATES), *(" ".join(rng.choices(all_words, k=200)) for _ in range(20)), "", None]
    for _ in range(60):  # notices with words lost, changed or doubled, several a text
        parts = []
        for _, text, _ in rng.sample(TEMPLATES, rng.randint(1, 6)):
            ws = text.split()
            for _ in range(rng.randint(0, 3)):
                at = rng.randrange(len(ws))
                ws[at : at + 1] = rng.choice([[], ["x"], [ws[at], ws[at]]])
            parts.append(" ".join(ws))
        texts.append(" -- ".join(parts))
    df = spark.createDataFrame([*enumerate(texts), (None, texts[0]), (0, texts[0])], "doc_id long, text string")
    df.coalesce(1).write.parquet(workdir + "/documents")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{workdir}/documents/*.parquet')")
    cur = con.execute(SQL["op9_license_scan"])
    names = [c[0] for c in cur.description]
    expected = sorted(map(repr, cur.fetchall()))
    got = scan_licenses(df).select(*names).collect()
    assert sorted(repr(tuple(r)) for r in got) == expected
    assert set(next(r.labels for r in got if r.doc_id == 0).split(",")) == {label for label, _, _ in TEMPLATES}


def test_feistel_is_a_permutation():
    for n in (1, 2, 3, 7, 100, 1009, 4096):
        assert sorted(feistel_int(i, n, 5) for i in range(n)) == list(range(n))
    assert [feistel_int(i, 1009, 5) for i in range(9)] != [feistel_int(i, 1009, 6) for i in range(9)]


def test_sharding_matches_plain_permutation(spark):
    rng = random.Random(2)
    rows = [(rng.choice([i, i, i % 40]), rng.choice(["", None, "ä", "text %d" % (i % 9), "long " * 300])) for i in range(501)]
    rows += [(None, "x"), (None, None)]
    df = spark.createDataFrame([(i, t, 3) for i, t in rows], "doc_id long, text string, shard int")
    got = sorted((tuple(r) for r in shard_rows(df.repartition(6), 8).collect()), key=str)
    slim = sorted(((i is not None, i or 0, zlib.crc32((t or "").encode()), len((t or "").encode()) + 1) for i, t in rows))
    want = []
    for k, (known, i, crc, size) in enumerate(slim):
        p = feistel_int(k, len(rows), 1)
        want.append((i if known else None, size, crc, "rows", p % 8, p // 8, None, p))
    assert got == sorted(want, key=str)
    counts = {}
    for r in got:
        counts.setdefault(r[4], []).append(r[5])
    assert all(sorted(v) == list(range(len(v))) for v in counts.values())
    assert max(map(len, counts.values())) - min(map(len, counts.values())) <= 1
    assert shard_rows(df.where("false")).count() == 0
    assert shard_rows(df.limit(1)).first().slot == 0
