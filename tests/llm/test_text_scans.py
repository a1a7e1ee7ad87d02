"""License scans, toxicity, quality, HTML and benchmark passages."""

from __future__ import annotations

import random
import re
import time

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from wattline.llm import decontaminate, quality, toxicity
from wattline.llm.decontaminate import contaminated, without_benchmark
from wattline.llm.html_text import extract, main_text
from wattline.llm.license_scan import BASE, compiled, scan, words_of


def licence_by_hand(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    places = [(i, label) for p, label in BASE for i in range(len(words)) if words[i : i + len(p.split())] == p.split()]
    starts = [i for i, _ in places]
    labels = ",".join(sorted({label for _, label in places}))
    return len(words), len(starts), min(starts, default=None), max(starts, default=None), labels


def test_base_phrases_and_words(spark, documents, empty):
    more = [
        (900, "The MIT License, the mit-license and\nMIT\tLICENSE; not mitlicense."), (901, "GNU General Public License v3"),
        (902, "general public general public license Apache  License"), (903, "é漢字 mit licenseé ß"),
    ]
    rows = documents.select("doc_id", "text").unionAll(spark.createDataFrame(more, "doc_id long, text string"))
    got = sorted((tuple(r) for r in scan(rows).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels").collect()), key=str)
    assert got == sorted(((r.doc_id, *licence_by_hand(r.text)) for r in rows.collect()), key=str)
    assert scan(empty).count() == 0


@pytest.mark.parametrize(
    ("text", "labels"),
    [
        ("Licensed under the Apache License, Version 2.0.", "apache,apache-2.0"),
        ("Apache License 2.0", "apache,apache-2.0"),
        ("Apache License, Version 1.1", "apache"),
        ("This work is licensed under the GNU General Public License, version 3.", "gpl,gpl-3.0"),
        ("Licensed under CC BY-NC 4.0.", "cc-by-nc"),
        ("licensed under a Creative Commons CC BY 4.0", "cc-by"),
        ("the BSD 3-Clause License", "bsd"),
        ("bsd one two three license", ""),
        ("a driving license", ""),
    ],
)
def test_templates(spark, text, labels):
    row = scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert row.labels == labels
    assert (row.score > 0) == bool(labels)
    assert 0 <= row.score <= 1


def test_optional_and_replaceable_regions():
    automaton = compiled("x", "one <<optional>>two three<<end>> <<any:2>> four")
    for text, end in [("one four", 2), ("one two three four", 4), ("one a four", 3), ("one two three a b four", 6), ("one two four", 3)]:
        assert automaton.match(words_of(text.encode()), 0) == end
    assert automaton.match(words_of(b"one a b c four"), 0) is None


BAD, GOOD = ["idiot", "stupid", "moron", "worthless"], "the and attion thing ernd onsh that erly hand there inter".split()


def labelled(spark, rows=400):
    rng = random.Random(3)
    docs, labels = [], []
    for i in range(rows):
        words = [rng.choice(GOOD) + rng.choice(["", "en", "er", "ing"]) for _ in range(rng.randrange(5, 60))]
        if i % 4 == 0:
            words[rng.randrange(len(words))] = rng.choice(BAD)
        docs.append((i, " ".join(words)))
        labels.append((i, int(i % 4 == 0)))
    labels += [(None, 1), (3, None), (10**6, 1)]
    return (
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(labels, "doc_id long, toxic int"),
    )


@pytest.fixture(scope="module")
def toxic_model(spark):
    docs, labels = labelled(spark)
    return toxicity.fit(docs, labels, toxicity.not_held_out())


HIDDEN = ["id10t", "1d1ot", "st*pid", "s t u p i d", "m.o.r.o.n", "stuuuupid", "w0rthless", "$tupid", "m-o-r-0-n", "STUPID", "stu​pid", "ídiot"]


def test_hidden_words_are_restored(spark, toxic_model):
    rows = [(i, f"the and attion {word} ernd thing") for i, word in enumerate(HIDDEN)]
    scored = toxicity.scored(spark.createDataFrame(rows, "doc_id long, text string"), toxic_model)
    assert {r.doc_id: r.score >= 0.5 for r in scored.collect()} == dict.fromkeys(range(len(HIDDEN)), True)
    restored = toxicity.restored(spark.createDataFrame(rows[:4], "doc_id long, text string"), toxic_model)
    assert {r.text.split()[3] for r in restored.collect()} == {"idiot", "stupid"}


LESS_PLAIN = ["idio7", "idio+", "id107", "id10+", "idi07", "iidiot", "idiiot", "sstupid", "stuupid", "moorron", "m0r0n", "s   t   u   p   i   d", "í d i o t", "(idio7)", "iidiot!"]


def test_look_alikes_at_ends_doubled_letters_and_wide_gaps(toxic_model):
    score = toxic_model.scorer()
    missed = [word for word in LESS_PLAIN if score(f"the and attion {word} ernd thing".encode()) < 0.5]
    assert not missed
    for plain in GOOD + ["inng!", "hand3", "there++", "thee", "onsh 10 that"]:
        assert score(f"the {plain} ernd".encode()) < 0.5


def test_held_out_toxicity_and_clean_texts(spark, toxic_model):
    docs, labels = labelled(spark)
    held = toxicity.scored(docs, toxic_model).join(labels, "doc_id").where(~toxicity.not_held_out()).collect()
    assert sum((r.score >= 0.5) == bool(r.toxic) for r in held) >= 0.99 * len(held)


def test_scores_of_awkward_rows(documents, empty, toxic_model):
    scored = toxicity.scored(documents, toxic_model).collect()
    assert len(scored) == documents.count()
    assert all(0 <= r.score < 0.5 for r in scored)
    assert toxicity.scored(empty, toxic_model).count() == 0
    kept = toxicity.without_toxic(documents, toxic_model)
    assert kept.columns == documents.columns and kept.count() == documents.count()


def test_models_without_labels(spark, documents):
    none = spark.createDataFrame([], "doc_id long, toxic int, quality int")
    model = toxicity.fit(documents.limit(20), none, toxicity.not_held_out())
    assert not model.lexicon and model.scorer()(b"idiot") < 0.5
    model = quality.fit(documents.limit(20), none, quality.not_held_out())
    assert 0 <= model.score(b"some text")[0] <= 1


def test_quality_learns_which_passage_decides(spark, documents, empty):
    rng = random.Random(9)
    docs, labels = [], []
    for i in range(300):
        words = [rng.choice(GOOD) + rng.choice(["", "en", "er"]) for _ in range(rng.randrange(100, 300))]
        if i % 3 == 0:
            at = rng.randrange(len(words) - 40)
            words[at : at + 40] = [w + "$$$" for w in words[at : at + 40]]
        docs.append((i, " ".join(words)))
        labels.append((i, int(i % 3 != 0)))
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame(labels, "doc_id long, quality int")
    model = quality.fit(docs, labels, quality.not_held_out())
    held = quality.scored(docs, model).join(labels, "doc_id").where(~quality.not_held_out()).collect()
    assert sum((r.score >= 0.5) == bool(r.quality) for r in held) >= 0.95 * len(held)
    assert all(abs(sum(r.weights) - 1) < 1e-3 for r in held)
    awkward = quality.scored(documents, model).collect()
    assert len(awkward) == documents.count() and all(0 <= r.score <= 1 for r in awkward)
    assert quality.scored(empty, model).count() == 0


def test_gradients_of_the_attention_model():
    rng = np.random.default_rng(0)
    bags = [rng.normal(size=(n, quality.WIDTH)).astype(np.float32) for n in (1, 3, 2)]
    wanted, which = np.array([1.0, 0.0, 1.0]), np.repeat(np.arange(3), [1, 3, 2])
    model = quality.learned(bags, wanted)
    raw = np.concatenate(bags)

    def loss():
        score = model.forward(raw, which, 3)["score"]
        return -np.mean(wanted * np.log(score) + (1 - wanted) * np.log(1 - score))

    gradients = model.gradients(raw, which, wanted)
    for name, part in model.parts.items():
        place = tuple(0 for _ in part.shape)
        kept = part[place]
        part[place] = kept + 1e-5
        up = loss()
        part[place] = kept - 1e-5
        down = loss()
        part[place] = kept
        assert abs((up - down) / 2e-5 - gradients[name][place]) < 1e-5


PAGE = """<html><head><title>T</title><style>p{}</style></head><body><header><h1>Site</h1></header>
<nav><ul><li><a href="/">Home</a></li></ul></nav><div class="ad">Buy, buy, buy now!</div>%s
<aside>Also, see this.</aside><form><label>Name</label></form><footer>&copy; us</footer></body></html>"""


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (PAGE % "<article><h1>Head</h1><p>One,\n two &amp; three.<p>Four <b>five</b><br>six</article>", "Head\nOne, two & three.\nFour five\nsix"),
        (PAGE % '<div class="post"><p>First, long text.</p><p>Second, text.</p></div><div class="comments"><p>Nice, thanks!</p></div>', "First, long text.\nSecond, text."),
        (PAGE % '<main><p a=">" >x&lt;y</p><script>var t="</p>";</script><p>z</p></main>', "x<y\nz"),
        ("<article><p>cut off he", "cut off he"),
        ("<article><p>cut off <a hre", "cut off"),
        ("no markup &amp; no end", "no markup & no end"),
        ("", ""),
        ("<div><!-- only a comment --></div>", ""),
    ],
)
def test_main_text(page, text):
    assert main_text(page) == text


LONG = "A long sentence, with commas, and some more of it, stands here. Another one follows it, as they do."


@pytest.mark.parametrize(
    ("body", "text"),
    [
        (f"<article><p>{LONG}</p></article><article><p>Second, {LONG}</p></article>", f"{LONG}\nSecond, {LONG}"),
        (f'<div class="wrap"><article><p>{LONG}</p></article><div class="x"><b>Tags</b></div><article><h2>Two</h2><p>{LONG}</p></article></div>', f"{LONG}\nTwo\n{LONG}"),
        (f'<div class="x"><i>Now</i></div><article><h1>One</h1><div class="lead"><p>{LONG}</p></div><ul><li>point</li></ul></article>', f"One\n{LONG}\npoint"),
        (f'<article><a href="/a">Short teaser</a></article><div class="long"><p>{LONG}</p><p>{LONG}</p></div>', f"{LONG}\n{LONG}"),
        (f'<div class="a"><p>{LONG}</p></div><div class="b"><i>Now</i></div><div class="a"><p>Also, {LONG}</p></div>', f"{LONG}\nAlso, {LONG}"),
    ],
)
def test_ratios_choose_the_containers_with_and_without_articles(body, text):
    assert main_text(PAGE % body) == text


def test_pages_with_nulls_and_repeats(spark):
    rows = [(1, "u", "<article>a b</article>", "x"), (1, "u", "<article>a b</article>", "x"), (None, None, None, None), (2, "v", "", "y")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted((tuple(r) for r in extract(pages).collect()), key=str)
    assert got == sorted([(1, "u", "a b", 3), (1, "u", "a b", 3), (None, None, "", 0), (2, "v", "", 0)], key=str)
    assert extract(pages.limit(0)).count() == 0


def longest_by_hand(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x and x == y else max(row[j], row[j - 1])
    return row[-1]


def test_common_subsequences():
    rng = random.Random(1)
    for _ in range(200):
        a, b = ([rng.randrange(6) for _ in range(rng.randrange(1, 80))] for _ in range(2))
        assert decontaminate.common_length(a, b) == longest_by_hand(a, b)


def test_sketch_finds_the_leading_singular_vectors():
    rng = np.random.default_rng(4)
    rows = rng.normal(size=(300, 6)) @ rng.normal(size=(6, decontaminate.WIDTH)) + 1e-4 * rng.normal(size=(300, decontaminate.WIDTH))
    test = np.linalg.qr(rng.normal(size=(decontaminate.WIDTH, 20)))[0]
    found = decontaminate.singular_vectors(rows.T @ (rows @ test), test, 6)
    wanted = np.linalg.svd(rows, full_matrices=False)[2][:6].T
    assert np.linalg.svd(found.T @ wanted)[1].min() > 0.999


def test_benchmark_passages(spark, documents, empty):
    rng = random.Random(8)
    items = [(i, " ".join(f"q{rng.randrange(300)}" for _ in range(rng.randrange(18, 60)))) for i in range(20)]
    items += [(20, None), (21, ""), (None, items[0][1]), (0, items[0][1])]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    clean = [(r.doc_id, r.text) for r in documents.select("doc_id", "text").collect()]
    leaked, wanted = [], set()
    for n in range(40):
        number, text = items[n % 20]
        words = text.split()
        if n >= 20:
            for _ in range(len(words) // 8):
                words[rng.randrange(len(words))] = "changed"
        around = [w for _, t in rng.sample(clean, 2) for w in (t or "").split()[:80]]
        leaked.append((1000 + n, " ".join(around[:50] + words + around[50:]).upper()))
        wanted.add((1000 + n, number))
    docs = spark.createDataFrame(clean + leaked, "doc_id long, text string")
    found = contaminated(docs, benchmark)
    got = {(r.doc_id, r.item_id) for r in found.collect()}
    assert {pair for pair in got if pair[1] is not None} == wanted
    assert {d for d, i in got if i is None} == {d for d, i in wanted if i == 0}
    kept = without_benchmark(docs.withColumn("score", F.lit(1)), benchmark)
    assert kept.columns == ["doc_id", "text", "score"] and kept.count() == len(clean)
    assert contaminated(empty, benchmark).count() == 0
    assert contaminated(documents, benchmark.limit(0)).count() == 0


@pytest.mark.parametrize("clean", [20, 1200])
def test_paraphrases_are_found_however_many_passages_there_are(spark, clean):
    rng = random.Random(21)
    items = [(i, " ".join(f"q{rng.randrange(300)}" for _ in range(40))) for i in range(30)]
    rows = []
    for number, text in items:
        words = text.split()
        changed = len(words) * (25 + number % 6) // 100
        for n in range(changed):
            words[n * len(words) // changed] = f"z{rng.randrange(10**6)}"
        rows.append((number, " ".join(words)))
    rng = random.Random(22)
    common = (" ".join(f"q{rng.randrange(300)}" if rng.random() < 0.6 else f"x{rng.randrange(10**6)}" for _ in range(250)) for _ in range(clean))
    rows += [(1000 + i, text) for i, text in enumerate(common)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = contaminated(docs, spark.createDataFrame(items, "item_id long, text string")).collect()
    assert len({r.doc_id for r in found if r.doc_id == r.item_id}) >= 28
    assert not [r for r in found if r.doc_id >= 1000]


def test_long_benchmarks_go_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(decontaminate, "ITEMS", 3)
    items = [(i, " ".join(f"b{i}x{j}" for j in range(25))) for i in range(8)]
    docs = spark.createDataFrame([(i, f"before {t} after") for i, t in items], "doc_id long, text string")
    found = contaminated(docs, spark.createDataFrame(items, "item_id long, text string"))
    assert {(r.doc_id, r.item_id) for r in found.collect()} == {(i, i) for i in range(8)}


ARTICLE = "<article><h1>A heading</h1><p>" + "A long paragraph of plain prose, with commas, and a full stop. " * 6 + "</p></article>"


@pytest.mark.parametrize(
    "wrapper",
    [
        'div class="layout has-sidebar"', 'div class="page no-sidebar"', 'div class="with-header"', 'div class="col ad-free"',
        'section class="legal"', 'form action="/"', 'div class="search"',
    ],
)
def test_a_wrapper_with_a_telling_name_keeps_its_article(wrapper):
    tag = wrapper.split()[0]
    page = f"<body><div class='menu'><a href='/'>Home</a> Menu words</div><{wrapper}>{ARTICLE}<div class='comments'>Nice, very nice.</div></{tag}><div class='sidebar'>Other things, here.</div></body>"
    found = main_text(page)
    assert found.startswith("A heading\nA long paragraph") and not re.search("Menu|Nice|Other", found)


def test_comments_longer_than_the_article_are_left_out():
    comments = "".join(f"<article class='comment'><p>Comment number {i}, it says a lot, and goes on.</p></article>" for i in range(3))
    page = f"<body><main>{ARTICLE}</main><section class='comments'>{comments}<p>{'More words, and more. ' * 80}</p></section></body>"
    assert "Comment" not in main_text(page) and "More" not in main_text(page)


def test_a_page_without_an_article_keeps_the_wrapper_of_its_heading():
    page = f"<body><div class='header'>Top, of the page.</div><div class='ad-free'>{ARTICLE.replace('article', 'div')}</div></body>"
    assert main_text(page).startswith("A heading\nA long")


@pytest.mark.parametrize(
    "page",
    ["<div>" * 100_000 + "deep text, here." + "</div>" * 100_000, "".join(f"<p class='c{i}'>text, {i}</p>" for i in range(100_000)), "<p><b>" * 50_000 + "x"],
)
def test_deep_and_varied_pages_take_time_in_proportion(page):
    begin = time.process_time()
    assert main_text(page)
    assert time.process_time() - begin < 30


def plain_model():
    costs = np.full((28, 28, 28), 3.0)
    return toxicity.Model(costs, {b"idiot": 0.99}, 0.01)


@pytest.mark.parametrize("words", ["idio7", "well,and,then,some,more,of,this,and,that,and,all,the,rest,you,idio7,again", "x1" * 40 + ",idio7"])
def test_hidden_words_in_long_tokens(words):
    assert plain_model().scorer()(words.encode()) > 0.9


def test_long_tokens_without_hidden_words_stay_clean():
    score = plain_model().scorer()
    begin = time.process_time()
    assert score(b"aGVsbG8xMjM0" * 20_000) < 0.1
    assert score(b"1" * 200_000 + b"a") < 0.1
    assert time.process_time() - begin < 60


def test_words_in_reach_are_counted_for_items_together(monkeypatch):
    rng = np.random.default_rng(3)
    none = np.zeros(0, int)
    items = [rng.integers(1, 30, n) for n in (5, 12, 9, 20)]
    index = decontaminate.Index([], items, {}, none, none, np.zeros(31), none, none, none, none)
    ids = rng.integers(0, 31, 400)
    at = np.sort(rng.integers(0, 4, 60))
    lows = rng.integers(0, 300, 60)
    highs = lows + rng.integers(1, 100, 60)
    expected = [int(np.isin(ids[a:b], items[i]).sum()) for i, a, b in zip(at, lows, highs, strict=True)]
    for bound in (1, 1 << 22):
        monkeypatch.setattr(decontaminate, "COUNTS", bound)
        assert index._in_reach(ids, at, lows, highs).tolist() == expected


def test_the_driver_gets_no_row_per_training_document(spark, monkeypatch):
    words = ["alpha", "beta", "gamma", "delta", "epsilon", "zeta"]
    docs = [(i, f"{words[i % 6]} {words[i % 5]} text{i} here" + (" vileword" if i % 4 == 0 else "")) for i in range(400)]
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i, _ in docs], "doc_id long, toxic int")
    kind, sizes = type(labels), []
    collect = kind.collect
    monkeypatch.setattr(kind, "collect", lambda self: [rows := collect(self), "doc" in str(self.columns) or "sketch" in self.columns and sizes.append(len(rows))][0])
    model = toxicity.fit(spark.createDataFrame(docs, "doc_id long, text string"), labels, toxicity.not_held_out())
    assert not sizes and model.lexicon[b"vileword"] > 0.95


def test_words_are_numbered_as_they_are_cut_one_by_one(monkeypatch):
    rng = random.Random(1)
    known = {b"a": 1, b"bb": 2, "é".encode(): 3, b"7": 4, "漢字".encode(): 5}
    found = [b"", None, b" ", b"  a ", b"a", b"A,bb;  7", b"\xff\xfe a \x00a", "é É a漢字 漢字".encode()]
    found += [bytes(rng.choice(b"aAbB7 \t\n.,\xc3\xa9\x00\xff") for _ in range(rng.randrange(30))) for _ in range(300)]
    for cut in (1, 10, 1 << 20):
        monkeypatch.setattr(decontaminate, "CUT", cut)
        for column in (pa.array(found, pa.binary()), pa.array([b"zz", *found], pa.binary())[1:], pa.array([], pa.binary())):
            got = [ids.tolist() for ids in decontaminate.numbers(column, known)]
            assert got == [[known.get(w, 0) for w in words_of(t or b"")] for t in column.to_pylist()]
    assert [ids.tolist() for ids in decontaminate.numbers(pa.array([b"a b"], pa.binary()), {})] == [[0, 0]]


def numbered(index, text):
    return next(decontaminate.numbers(pa.array([text.encode()], pa.binary()), index.vocabulary))


def test_items_left_out_before_the_comparison_are_never_found(spark, monkeypatch):
    rng = random.Random(6)
    items = [" ".join(f"q{min(rng.randrange(90), rng.randrange(90))}" for _ in range(rng.choice([1, 3, 10, 25, 60]))) for _ in range(40)]
    found = []
    for n in range(150):
        words = [f"q{rng.randrange(90)}" if rng.random() < 0.1 * (n % 7) else f"x{rng.randrange(10**6)}" for _ in range(rng.choice([0, 5, 40, 600]))]
        for item in rng.sample(items, n % 4):
            changed = [w if rng.random() < 0.8 else "z" for w in item.split()]
            at = rng.randrange(len(words) + 1)
            words[at:at] = changed
        found.append(" ".join(words))
    docs = spark.createDataFrame(list(enumerate(found)), "doc_id long, text string")
    index = decontaminate.build(docs, [(i, t.encode()) for i, t in enumerate(items)])
    every = [numbered(index, text) for text in found]
    left_out = sum(int((~index._possible(ids)).sum()) for ids in every)
    assert left_out > len(every) * len(items) // 4
    got = []
    for together in (1, 3, 128):
        monkeypatch.setattr(decontaminate, "TOGETHER", together)
        got.append([index.matches(ids) for ids in every])
    monkeypatch.setattr(decontaminate.Index, "_possible", lambda self, ids: np.ones(len(self.items), bool))
    wanted = [index.matches(ids) for ids in every]
    assert sum(map(len, wanted)) > 100 and got == [wanted] * 3


def test_texts_that_can_hold_no_item_are_not_compared(spark, monkeypatch):
    item = " ".join(f"b{i}" for i in range(30))
    plain = " ".join(f"b{i % 10} other words {i}" for i in range(400))
    docs = spark.createDataFrame([(0, plain), (1, f"{plain} {item}")], "doc_id long, text string")
    index = decontaminate.build(docs, [(0, item.encode())])
    compared, unit = [], decontaminate.unit
    monkeypatch.setattr(decontaminate, "unit", lambda vectors: [compared.append(len(vectors)), unit(vectors)][1])
    assert not index.matches(numbered(index, plain)) and not compared
    assert index.matches(numbered(index, f"{plain} {item}"))[0][:2] == (0, 1.0) and sum(compared) <= 2 * decontaminate.TOGETHER


def test_the_sketch_is_that_of_all_passages(spark):
    rng = np.random.default_rng(9)
    known = {f"w{i}".encode(): i + 1 for i in range(60)}
    columns, values = np.append(0, rng.integers(0, 40, 60)), np.append(0.0, rng.normal(size=60))
    found = [" ".join(f"w{rng.integers(0, 60)}" if rng.random() < n % 5 / 4 else "unknown" for _ in range(rng.integers(0, 120))) for n in range(50)]
    dense = []
    for text in found:
        ids = np.array([known.get(w, 0) for w in words_of(text.encode())], int)
        for begin in range(0, len(ids), decontaminate.PASSAGE):
            dense.append(np.bincount(columns[ids[begin : begin + decontaminate.PASSAGE]], values[ids[begin : begin + decontaminate.PASSAGE]], decontaminate.WIDTH))
    test = rng.normal(size=(decontaminate.WIDTH, 3))
    docs = decontaminate.texts(spark.createDataFrame(list(enumerate(found)), "doc_id long, text string"))
    model = spark.sparkContext.broadcast((known, columns, values))
    rows = np.array(dense)
    assert np.allclose(decontaminate._sketch(model, docs, test), rows.T @ (rows @ test))


def test_passages_are_gathered_in_bounded_blocks(monkeypatch):
    monkeypatch.setattr(decontaminate, "GATHERED", 4)
    blocks = []
    gathered = decontaminate.Gathered(blocks.append)
    parts = [np.arange(16 * n, dtype=np.int32).reshape(-1, 16) + 1 for n in (0, 1, 2, 11, 3)]
    for part in parts:
        gathered.add(np.concatenate([part, np.zeros((2, 16), np.int32)]))
    gathered.close()
    gathered.close()
    assert max(map(len, blocks)) <= 4 and np.array_equal(np.concatenate(blocks), np.concatenate(parts))
