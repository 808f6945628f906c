"""Language, personal data, packing, decontamination and page text."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from regspark.llm import html_text, langid, packing, pii
from regspark.llm.decontaminate import contaminated, leaked_dropped, normalise, pieces, substring_distance

SF = "/root/testdata/sf0.001"


# --- language ------------------------------------------------------------------

def test_codewords_are_spread():
    for n in (2, 3, 4, 6, 9, 40):
        code = langid.codewords(n)
        gaps = [(code[i] != code[j]).sum() for i in range(n) for j in range(i)]
        assert min(gaps) >= (1 if n == 2 else 2 if n == 3 else 4)
    assert langid.codewords(0).shape == (0, 0) and langid.codewords(1).shape == (1, 0)


def test_language_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == docs.count()
    held = [r for r in rows if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    assert sum(r.lang_pred == r.lang for r in held) >= 0.98 * len(held) > 20
    assert all(0 <= r.score <= 1 for r in rows)


def test_language_edge_cases(spark):
    schema = "doc_id long, text string, lang string, score string"
    rows = [(1, "the cat and the dog", "en", "x"), (2, None, "en", "x"), (3, "12 34 !!", "en", "x"), (4, "", None, "x"),
            (None, "the dog", None, "x"), (1, "the cat and the dog", "en", "x"), (8, "a" * 3_000_000, None, "x")]
    df = spark.createDataFrame(rows, schema)
    got = {(r.doc_id, r.lang_pred) for r in langid.identify(df).collect()}
    assert got == {(1, "en"), (2, "und"), (3, "und"), (4, "und"), (None, "en"), (8, "en")}
    assert {r.lang_pred for r in langid.identify(df.withColumn("lang", df.lang.substr(9, 1).cast("string"))
                                                 .selectExpr("doc_id", "text", "string(null) AS lang")).collect()} == {"und"}
    assert langid.identify(df.where("false")).count() == 0
    kept = langid.unknown_dropped(df)
    assert kept.schema == df.schema and sorted(str(r.doc_id) for r in kept.collect()) == ["1", "1", "8", "None"]


# --- personal data -----------------------------------------------------------------

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_base(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    out = [("email", *m.span()) for m in EMAIL.finditer(text)]
    out += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        d = digits(m[0])
        total = sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d)))
        if 16 <= len(d) <= 19 and total % 10 == 0:
            out.append(("card", *m.span()))
    return out + [("phone", *m.span()) for m in PHONE.finditer(text) if 8 <= len(digits(m[0])) <= 15]


def test_base_spans_match_the_patterns():
    rng = random.Random(7)
    alphabet = ["a", "b.", "@", "@x.y", ".", "-", " ", "1", "23", "255.", "1.2.3.4", "+1 ", "(555) ", "4111 1111 1111 1111",
                "5500005555555559", "%", "_", "é", "\n", "+49-30.1234567", "x@y.z_w@q.r"]
    for _ in range(3000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 14)))
        assert pii.base_spans(text) == plain_base(text), text


def test_base_spans_are_linear_in_long_runs():
    for text in ("a" * 400_000, "1" * 400_000, "a@" * 200_000, "1.2." * 100_000 + "x", "+1" * 150_000):
        pii.base_spans(text)


@pytest.fixture(scope="module")
def crf():
    return pii.Crf()


def test_chain_learns_its_table_and_more(crf):
    memory, right, total = {}, 0, 0
    for words, tags in pii._sentences():
        got = {a: t for a, _, t in pii.tagged_words(crf, " ".join(words), memory)}
        at = 0
        for w, t in zip(words, tags):
            right, total, at = right + (got.get(at, 0) == t), total + 1, at + len(w) + 1
    assert right >= 0.97 * total
    base, both = pii.all_spans(crf, 'und token = "0a1b2c3d4e5f60718293a4b5c6d7e8f901234567" sch ring (617) 555-7714 thst', {})
    assert not base and [k for k, _, _ in both] == ["phone", "secret"]
    assert pii.all_spans(crf, "the 2390409500648961 and in 1998 the 3rd of 12 was 10:45 on", {}) == ([], [])


def test_viterbi_splitting_is_exact(crf):
    rng = np.random.default_rng(0)
    for _ in range(30):
        e = rng.normal(0, 3, (40, crf.labels)).astype(np.float32)
        e[rng.random(40) < 0.5, 0] += 20
        score, back = crf.trans[0] + e[0], []
        for t in range(1, 40):
            cand = score[:, None] + crf.trans
            back.append(cand.argmax(axis=0))
            score = cand.max(axis=0) + e[t]
        path = [int((score + crf.trans[:, 0]).argmax())]
        for b in reversed(back):
            path.append(int(b[path[-1]]))
        assert crf.decode(e, np.zeros(40, bool)).tolist() == path[::-1]


def test_personal_data_rows(spark):
    texts = ["mail a.b@c.example.org now", "ring +1 (202) 555-0143", None, "", "1.2.3.4 and 300.1.1.1 é a@b.c", "x " * 700_000 + "a@b.cc"]
    df = spark.createDataFrame([(i, t, "s") for i, t in enumerate(texts)] + [(None, "a@b.c", "s")], "doc_id long, text string, spans string")
    got = {r.doc_id: r for r in pii.find_personal_data(df).collect()}
    for i, t in [*enumerate(texts), (None, "a@b.c")]:
        base = plain_base(t or "")
        r = got[i]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s[0] == k for s in base) for k in pii.BASE]
        line = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert r.base_sha256 == hashlib.sha256(line.encode()).hexdigest()
        assert {f"{k}:{a}:{b}" for k, a, b in base} <= set(r.spans.split(",")) | {""}
    assert pii.find_personal_data(df.where("false")).count() == 0


def test_masking_keeps_rows(spark):
    df = spark.createDataFrame([(1, "write a@b.cc or 1.2.3.4!", 24), (2, None, 7), (3, "clean text", 10)], "doc_id long, text string, n_chars long")
    got = {r.doc_id: (r.text, r.n_chars) for r in pii.masked(df).collect()}
    assert got == {1: ("write [EMAIL] or [IP]!", 22), 2: (None, 7), 3: ("clean text", 10)}
    clash = df.selectExpr("doc_id", "text", "'x' AS TEXT")
    assert sorted(str(r[1]) for r in pii.masked(clash).collect()) == ["None", "clean text", "write [EMAIL] or [IP]!"]
    assert pii.redact("abcdef", [("ip", 1, 4), ("card", 2, 3), ("phone", 3, 5)]) == "a[IP]f"


# --- packing --------------------------------------------------------------------------

def test_packing_round_trip(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    judge = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rng = random.Random(4)
    texts = ["", None, "one", "word " * 5000, "é ß 漢字 🙂 \u200b x", "  \n\t ", "a" * 3000]
    texts += [" ".join(rng.choice("the of and ñ 12 foo-bar".split()) for _ in range(rng.randint(1, 900))) for _ in range(120)]
    rows = list(enumerate(texts))
    df = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id long, text string, offset int").repartition(3)
    got = packing.pack_documents(df, 512).collect()
    by_doc, by_seq = {}, {}
    for r in got:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    for i, t in rows:
        ids = [*judge.encode(t or "", add_special_tokens=False).ids, 1]
        at = 0
        for r in sorted(by_doc[i], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)
    partial = 0
    for parts in by_seq.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at and r.length > 0
            at += r.length
        assert at <= 512
        partial += at < 512
    assert partial <= 3  # one window a task
    assert packing.pack_documents(df.where("false")).count() == 0


def test_encoder_agrees_on_odd_unicode():
    import public_tokenizers
    from tokenizers import Tokenizer

    judge = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    encoder = packing.load_encoder(packing.vocabulary_path())
    rng = random.Random(9)
    pool = [chr(c) for c in [*range(32, 127), *range(0xA0, 0x250), 0x3A9, 0x416, 0x627, 0x915, 0x4E2D, 0x1F600, 0x200B, 0x2028, 0x301, 0xB2, 0x2160]]
    for _ in range(400):
        text = "".join(rng.choice(pool + [" "] * 40 + ["\n", "\t", "'s", "'ll"]) for _ in range(60))
        assert encoder.encode_ordinary(text) == judge.encode(text, add_special_tokens=False).ids


def test_added_tokens_are_read_as_by_tokenizers(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    judge = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    end = "<|endoftext|>"
    texts = [f"one {end} two", end, end * 3, f"{end}x", f"ä {end}\n\n{end} 漢", "<|endoftext|", "<|endof" + end + "text|>", f"a{end}'s <|x|>", "<|EndOfText|>"]
    want = {i: [*judge.encode(t, add_special_tokens=False).ids, 1] for i, t in enumerate(texts)}
    assert want[0] == [505, 220, 50256, 734, 1]
    got = packing.pack_documents(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1), 64).collect()
    for r in got:
        ids = want[r.doc_id]
        assert r.doc_tokens == len(ids) and r.ids_crc32 == zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes())
    assert {r.doc_id for r in got} == set(want)


def test_long_runs_of_white_space(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    judge = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    encoder = packing.Encoder(packing.vocabulary_path())
    end = "<|endoftext|>"
    texts = ["a" + "\n" * 1_000_000, " " * 2_000_000 + "word", "x" + " " * 2001 + end + " " * 2500 + end + "y", "\xa0" * 2200 + " q",
             "a" + " " * 3000 + "\n" * 3000 + "b \t" * 2000 + "\u3000" * 2100 + "\x1c" * 2100 + "z", " " * 1999 + "'s"]
    for text in texts:
        assert encoder.ids(text) == judge.encode(text, add_special_tokens=False).ids
    rows = packing.pack_documents(spark.createDataFrame([(1, " " * 2_000_000), (2, None)], "doc_id long, text string")).collect()
    assert {r.doc_id: r.doc_tokens for r in rows} == {1: 2_000_001, 2: 1}


def test_open_windows_are_bounded(monkeypatch):
    monkeypatch.setattr(packing, "MAX_OPEN", 20)
    w = packing.Windows(2048, 0)
    for k in range(1000):
        w.place(k, 0, np.full(1500, k, np.uint32), 1500)
        assert len(w.held) <= 20 and sum(map(len, w.open.values())) == len(w.held) == w.count.sum()
    w.finish()
    assert not w.held and sum(r[2] for r in w.rows) == 1_500_000
    filled = {}
    for doc, start, length, _, _, window, offset in w.rows:
        filled[window] = filled.get(window, 0) + length
    assert sum(n < 2048 for n in filled.values()) <= 1
    for doc in range(1000):
        pieces = sorted((r[1], r[2]) for r in w.rows if r[0] == doc)
        assert [a for a, _ in pieces] == [0, *np.cumsum([n for _, n in pieces])[:-1]] and sum(n for _, n in pieces) == 1500


def test_sum_of_squares_rule_is_the_minimum():
    rng = np.random.default_rng(3)
    w = packing.Windows(16, 0)
    for k in range(300):
        s = int(rng.integers(1, 16))
        before = w.count.copy()
        options = {}
        for h in [0] + [h for h in range(1, 17 - s) if before[h]]:
            n = before.copy()
            if h:
                n[h] -= 1
            if h + s < 16:
                n[h + s] += 1
            options[h] = int((n[:16] ** 2).sum())
        h = w.choose(s)
        assert h in options and options[h] == min(options.values())
        w.place(k, 0, np.zeros(s, np.uint32), s)
    w.finish()
    assert sum(r[2] for r in w.rows) > 0 and not w.held


# --- decontamination --------------------------------------------------------------------

def edit_substring(item, text):
    prev = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        row = [i]
        for j, d in enumerate(text, 1):
            row.append(min(prev[j - 1] + (c != d), prev[j] + 1, row[-1] + 1))
        prev = row
    return min(prev)


def test_myers_distance_is_exact():
    rng = random.Random(5)
    for _ in range(400):
        item = "".join(rng.choice("abc") for _ in range(rng.randint(1, 90)))
        text = "".join(rng.choice("abc") for _ in range(rng.randint(0, 60)))
        assert substring_distance(item, text) == edit_substring(item, text)


def test_pieces_cover_the_item():
    assert "".join(p for _, p in pieces("abcdefghij", 3)) == "abcdefghij" and len(pieces("abcdefghij", 3)) == 4


@pytest.mark.parametrize("block_chars", [10_000, 300])
def test_contamination_matches_brute_force(spark, block_chars):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 6)))
    items = [(k, " ".join(word() for _ in range(rng.randint(9, 25)))) for k in range(10)] + [(50, "too short"), (51, None), (None, "x " * 20)]
    docs = []
    for i in range(120):
        text = [word() for _ in range(rng.randint(0, 60))]
        if i % 2:
            leak = list(rng.choice(items[:10])[1])
            for _ in range(rng.choice((0, 1, 3, 6, 9, 14))):
                leak[rng.randrange(len(leak))] = rng.choice("abcdefgh ")
            text.insert(len(text) // 2, rng.choice(("", "«")) + "".join(leak).upper())
        docs.append((i, " ".join(text)))
    docs += [(900, None), (901, ""), (None, items[0][1])]
    df = spark.createDataFrame([(i, t, "e") for i, t in docs], "doc_id long, text string, edits string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.edits for r in contaminated(df, bench, 0.06, block_chars=block_chars).collect()}
    want = {}
    for i, t in docs:
        for k, item in items[:10]:
            item, budget = normalise(item), int(0.06 * len(normalise(item)))
            d = edit_substring(item, normalise(t))
            if d <= budget:
                want[i, k] = d
    assert got == want and len({i for i, _ in want}) > 20
    kept = leaked_dropped(df, bench)
    assert kept.schema == df.schema
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(i) for i, _ in docs if i not in {a for a, _ in want})
    assert contaminated(df.where("false"), bench).count() == contaminated(df, bench.where("false")).count() == 0


def test_short_and_unspaced_items_are_found(spark):
    items = [(1, "What is the capital of France?"), (2, "光合作用によって植物は二酸化炭素と水から糖と酸素を作り出すことができる"), (3, "中国的首都"),
             (4, "Paris"), (5, " -- "), (6, "")]
    texts = ["Q: WHAT is the capital -- of France", "what is the capital of Frances", "昨日、光合作用によって植物は二酸化炭素と水から糖と酸素を作り出すことができると聞いた",
             "光合作用によって植物は二酸化炭素と水から塩と酸素を作り出すことができる", "请问中国的首都是哪里", "comParison", "in paris.", "--", None,
             "what was the capital of france"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = sorted((r.doc_id, r.item_id, r.edits, r.budget) for r in contaminated(df, bench).collect())
    assert got == [(0, 1, 0, 0), (2, 2, 0, 2), (3, 2, 1, 2), (4, 3, 0, 0), (6, 4, 0, 0)]
    assert [r.doc_id for r in leaked_dropped(df, bench).orderBy("doc_id").collect()] == [1, 5, 7, 8, 9]


# --- pages --------------------------------------------------------------------------------

def test_blocks_cut_pages_into_leaves():
    page = ("<!DOCTYPE html><title>T</title><style>p{}</style><script>var t=\"</p>\";</script><nav><ul><li><a href='/x'>Menu</a></ul></nav>"
            "<article class='Post main'><h1>A &amp; B</h1><p>one<b>two</b>  three<br>four<p>five &lt;x&gt; &am")
    got = html_text.blocks(page)
    assert [b.text for b in got] == ["Menu", "A & B", "onetwo three", "four", "five <x> &am"]
    assert got[0].linked == 4 and got[0].path == ["nav", "ul", "li"]
    assert got[2].path == ["article", ".post", ".main", "p"] and html_text.blocks("") == []
    assert [b.text for b in html_text.blocks("<p>cut <a hre")] == ["cut"]


def test_deep_markup_does_not_hide_the_deciding_ancestor():
    net = html_text.train()
    article = ("<article><h1>The long way home</h1><p>The river ran slowly past the old mill and the children watched it from the bridge.</p>"
               "<p>Later that day the miller told them a story about the flood of the year before.</p></article>")
    replies = "<p>I remember that flood well, we lost the whole harvest that year.</p><p>Nice story, thank you for writing it down for us.</p>"
    for names in ("col-md-6 mb-3 px-2", "row flex gap-4 w-full"):
        for deep in (0, 2, 4, 10, 30):
            wrap, end = f"<div class='{names}'>" * deep, "</div>" * deep
            inside = html_text.blocks(f"<body>{article}<section class='comments'>{wrap}{replies}{end}</section></body>")
            around = html_text.blocks(f"<body>{wrap}{article}<section class='comments'>{replies}</section>{end}</body>")
            assert [net.label([page])[0].tolist() for page in (inside, around)] == [[True] * 3 + [False] * 2] * 2, (names, deep)


def test_empty_and_unclosed_raw_elements_take_no_text_away():
    def texts(page):
        return [b.text for b in html_text.blocks(page)]

    assert texts("<p>one <svg class='i' />two</p><p>three</p>") == ["one two", "three"]
    assert texts("<p>one <svg/>two</p><p>three</p><svg><text>no</text></svg><p>four") == ["one two", "three", "four"]
    assert texts("<p>a</p><math display='block'/><p>b</p>") == ["a", "b"]
    for tag in ("object", "noscript", "svg", "math"):
        assert texts(f"<p>a</p><{tag} x='1'><p>b</p><{tag}><p>c") == ["a", "b", "c"]
        assert texts(f"<p>a</p><{tag}>no</{tag}><p>b") == ["a", "b"]
    assert texts("<p>a</p><script>var b") == ["a"]


def test_back_propagation_matches_finite_differences():
    rng = random.Random(2)
    pages = []
    while len(pages) < 3:
        page = html_text.blocks(html_text.training_page(rng))[:9]
        if page:
            pages.append(html_text.encode(page))
    p, q, x, live = html_text.padded(pages)
    net = html_text.Labeller()
    net.w = {k: v.astype(np.float64) for k, v in net.w.items()}
    y = (np.arange(live.size).reshape(live.shape) % 2).astype(float)

    def loss():
        z = net.logits(p, q, x, live)
        return float((np.where(live, np.logaddexp(0, z) - y * z, 0)).sum() / live.sum())

    # one plain step along the analytic gradient must lower the loss as first order predicts
    grads = {}
    original = {k: v.copy() for k, v in net.w.items()}
    v = net._inputs(p, q, x)
    kf, kb = [], []
    top = np.concatenate([net._run(v, live, "f", kf), net._run(v, live, "b", kb), v], axis=-1)
    z = (top @ net.w["out"])[..., 0] + net.w["bias"]
    e = np.where(live, 1 / (1 + np.exp(-z)) - y, 0) / live.sum()
    d = e[..., None] * net.w["out"][:, 0]
    h = html_text.HIDDEN
    net._back(d[..., :h], v, live, "f", kf, grads)
    net._back(d[..., h : 2 * h], v, live, "b", kb, grads)
    for name in ("xf", "hf", "cf", "xb", "hb", "cb"):
        direction = np.random.default_rng(1).standard_normal(net.w[name].shape)
        eps = 1e-4
        net.w[name] = original[name] + eps * direction
        up = loss()
        net.w[name] = original[name] - eps * direction
        down = loss()
        net.w[name] = original[name]
        want = float((grads[name] * direction).sum())
        assert abs((up - down) / (2 * eps) - want) < 1e-3 * max(1, abs(want)) + 2e-4, name


def test_main_text(spark):
    import html as h

    net = html_text.train()
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    got = html_text.main_text(pages, net).collect()
    source = {r.page_id: r.html for r in pages.collect()}
    right = 0
    for r in got:
        body = re.search(r"<article>(.*?)(</article>|\Z)", source[r.page_id], re.S)[1]
        right += r.text == " ".join(h.unescape(re.sub(r"</?(p|h1|br)>", " ", re.sub(r"</?b>", "", body))).split())
        assert r.n_chars == len(r.text)
    assert right >= 0.98 * len(source) and len(got) == len(source)
    # layouts of other seeds
    rng, wrong, total = random.Random(77), 0, 0
    for _ in range(150):
        page = html_text.blocks(html_text.training_page(rng))
        want = [b.text[0] == "\1" for b in page]
        for b in page:
            b.text = b.text.replace("\1", "") or "-"
        wrong, total = wrong + int((net.label([page])[0] != np.array(want, bool)).sum()), total + len(page)
    assert wrong <= 0.01 * total
    odd = spark.createDataFrame([(1, "u", None, "t"), (2, None, "", "t"), (None, "u", "<article><p>" + "long text. " * 200_000, "t")],
                                "page_id long, url string, html string, text string")
    rows = {r.page_id: r for r in html_text.main_text(odd, net).collect()}
    assert rows[1].text == rows[2].text == "" and rows[None].n_chars == 200_000 * 11 - 1
    assert html_text.main_text(odd.where("false"), net).count() == 0


# --- broken and deep mark-up ------------------------------------------------------------

def test_markup_that_is_never_closed_is_read_in_linear_time():
    import time

    began = time.perf_counter()
    deep = html_text.blocks("<div>x" * 100_000)
    assert len(deep) == 100_000 and deep[-1].node.fresh == [] and all(b.text == "x" for b in deep[:5])
    assert html_text.blocks("<a " * 300_000) == [] and html_text.blocks('<a "' * 200_000) == []
    assert html_text.blocks('<a ">' * 200_000 + "<p>end") and html_text.blocks('<p "x>y" ' * 100_000) is not None
    assert html_text.blocks("<div>" * 100_000 + "</p></li>" * 100_000) == []
    assert html_text.blocks("one<script>" + "</script " * 100_000)[0].text == "one"
    assert html_text.blocks("<!--" * 200_000 + "<p>x") == [] and len(html_text.blocks("<" * 300_000)) == 1
    assert time.perf_counter() - began < 30


def test_no_markup_in_the_text_of_unclosed_quotes():
    got = [b.text for b in html_text.blocks('<p>one</p><p title="bad>two</p><p>three</p>')]
    assert got == ["one", "two", "three"]
    assert [b.text for b in html_text.blocks("<p class='a>b'>in</p><p id=it's>out</p> a < b <3 </ x")] == ["in", "out", "a < b <3 </ x"]
    assert [b.text for b in html_text.blocks('<p a="x" b=">">t</p><p "x>y"')] == ["t", 'y"']
    assert [b.text for b in html_text.blocks("<p>kept</p><div class='end")] == ["kept"]


def test_path_sums_are_the_bags_of_the_paths():
    rng = random.Random(12)
    net = html_text.Labeller()
    net.known = frozenset(["div", "p", "nav", ".a", ".b", "li"])
    page = "".join(rng.choice(["<div class='a b'>", "<p>", "<nav id=c>", "</div>", "</nav>", "<ul><li class=a>", "</ul>", "<b>x</b> y ", "word "]) for _ in range(400))
    found = html_text.blocks(page)
    p, q, x = html_text.encode(found, net.known)
    want = net._inputs(p, q, x)
    assert len(found) > 50 and np.allclose(net.embedded(found), want, atol=1e-5)
    other = html_text.blocks(page[:900])
    v = np.zeros((2, len(found), want.shape[1]), np.float32)
    v[0], v[1, : len(other)] = want, net.embedded(other)
    live = np.arange(len(found)) < np.array([[len(found)], [len(other)]])
    for got, side in zip(net._both(v, live), "fb"):
        assert np.allclose(got[live], net._run(v, live, side)[live], atol=1e-5)


def test_labelling_a_deep_page_is_bounded(spark):
    import time
    import tracemalloc

    net = html_text.Labeller()
    for page in ("<div>x" * 30_000, "<a " * 340_000):
        began = time.perf_counter()
        tracemalloc.start()
        net.label([html_text.blocks(page)])
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 100e6 and time.perf_counter() - began < 60, (peak, time.perf_counter() - began)


# --- benchmark in many blocks -------------------------------------------------------------

def test_benchmark_blocks_are_read_one_at_a_time(spark, monkeypatch):
    from regspark.llm import decontaminate

    rng = random.Random(21)
    words = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(500)]
    items = [(i, " ".join(rng.choice(words) for _ in range(12))) for i in range(40)]
    docs = [(i, " ".join(rng.choice(words) for _ in range(30)) + (" " + items[i][1] if i % 3 == 0 else "")) for i in range(40)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = spark.createDataFrame([(*d, "a", "b") for d in docs], "doc_id long, text string, x string, Doc_ID string")
    whole = sorted(tuple(r) for r in contaminated(df, bench).collect())
    assert {r[0] for r in whole} >= {i for i in range(40) if i % 3 == 0}
    split = contaminated(df, bench, block_chars=150)
    assert sorted(tuple(r) for r in split.collect()) == whole and len(split.inputFiles()) > 0  # hits of blocks lie in files
    monkeypatch.setattr(decontaminate, "BLOCK_CHARS", 150)
    clean = leaked_dropped(df, bench)
    assert clean.columns == df.columns
    assert sorted(r[0] for r in clean.collect()) == sorted({d[0] for d in docs} - {r[0] for r in whole})


def test_a_worker_keeps_one_matcher():
    import sys

    from regspark.llm.common import process_slot

    made = [process_slot("matcher", str(k), lambda k=k: f"m{k}") for k in (1, 1, 2, 3, 3)]
    assert made == ["m1", "m1", "m2", "m3", "m3"]
    kept = sys.modules["regspark_worker_cache"].__dict__
    assert kept["matcher"] == ("3", "m3")
