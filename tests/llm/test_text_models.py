"""Language, quality, main text and personal data: held-out accuracy, brute force and awkward rows."""

import hashlib
import random
import re

import numpy as np
from pyspark.sql import functions as F

from rivulet.llm import boosting, bytecnn, langid, pages, pii, quality

SF = "/root/testdata/sf0.01"


def test_gradients_of_the_network():
    rng = np.random.default_rng(1)
    for bags in (False, True):
        model = bytecnn.ByteConv.fresh([0, 1, 2], (2, 3), 4, 3, bags=bags, seed=2)
        data = [rng.integers(0, 256, (3 if bags else 1, 12)).astype(np.uint8) for _ in range(5)]
        labels = rng.integers(0, 3, 5)

        def loss():
            windows = np.concatenate(data)
            pooled = model.responses(windows)
            starts = np.cumsum([0, *[len(b) for b in data[:-1]]])
            features = bytecnn.bag_features(pooled, starts) if bags else pooled
            return -np.log(model.head(features.astype(np.float64))[np.arange(5), labels]).mean()

        params = [model.embedding, *model.filters, model.bias, model.weights, model.offset]
        for p, g in zip(params, bytecnn._gradients(model, data, labels, bags)):
            for at in np.argsort(-np.abs(g).ravel())[:3]:
                old = p.ravel()[at]
                p.ravel()[at] = old + 1e-2
                up = loss()
                p.ravel()[at] = old - 1e-2
                down = loss()
                p.ravel()[at] = old
                assert abs((up - down) / 2e-2 - g.ravel()[at]) < 2e-2 + 0.2 * abs(g.ravel()[at])


def test_windows_cover_every_byte():
    data = bytes(range(250)) * 3
    for length, stride in ((64, 64), (64, 56), (1000, 900)):
        windows = bytecnn.windows_of(data, length, stride)
        seen = np.zeros(len(windows) * stride + length, int)
        for k in range(len(windows)):
            seen[k * stride : k * stride + length] += 1
        assert (seen[: len(data)] > 0).all() and windows.shape[1] == length
        assert bytes(windows[0])[: min(length, len(data))] == data[:length]
    assert bytecnn.windows_of(b"", 8, 8).shape == (1, 8)


def plain_responses(model, window):
    """Largest response of each filter over one window, byte by byte."""
    out = []
    for kernel in model.filters:
        width = len(kernel) // model.embedding.shape[1]
        for column in kernel.T.astype(float):
            places = range(len(window) - width + 1)
            out.append(max(sum(float(model.embedding[window[at + k], d]) * column[k * model.embedding.shape[1] + d] for k in range(width) for d in range(model.embedding.shape[1])) for at in places))
    return [max(0.0, r + float(b)) for r, b in zip(out, model.bias)]


def plain_softmax(model, features):
    logits = [sum(f * float(w) for f, w in zip(features, column)) + float(o) for column, o in zip(model.weights.T, model.offset)]
    top = max(logits)
    parts = [np.exp(x - top) for x in logits]
    return [p / sum(parts) for p in parts]


def plain_windows(data, length, stride):
    out, at = [], 0
    while True:
        out.append((list(data[at : at + length]) + [0] * length)[:length])
        if at + length >= len(data):
            return out
        at += stride


def test_language_scores_equal_plain_loops():
    rng = random.Random(5)
    texts = ["".join(rng.choice("abcdé xyz") for _ in range(n)) for n in (1, 3, 200, 256, 300, 700)]
    model = langid.fit([t.encode()[:256] for t in texts] * 3, ["x", "y", "z", "x", "y", "z"] * 3, rounds=1)
    for text, (lang, score) in zip(texts, langid.predict(model, texts)):
        data = text.lower().encode()
        total = np.zeros(3)
        for k, window in enumerate(plain_windows(data, langid.WINDOW, langid.WINDOW)):
            total += np.array(plain_softmax(model, plain_responses(model, window))) * min(langid.WINDOW, len(data) - k * langid.WINDOW)
        assert abs(total.max() / len(data) - score) < 1e-4
        assert model.classes[int(total.argmax())] == lang or np.ptp(np.sort(total)[-2:]) < 1e-3 * len(data)


def test_quality_scores_equal_plain_loops():
    rng = random.Random(6)
    texts = ["".join(rng.choice("abcdé xyz") for _ in range(n)) for n in (0, 1, 255, 256, 257, 600)] + [None]
    bags = [[(t or "").encode()[:256]] for t in texts]
    model = quality.fit(bags, [0, 1, 0, 1, 0, 1, 0], {0: 40, 1: 10}, rounds=1)
    for text, score in zip(texts, quality.scores(model, texts)):
        responses = np.array([plain_responses(model, w) for w in plain_windows((text or "").encode(), quality.CHUNK, quality.CHUNK - quality.OVERLAP)])
        assert abs(plain_softmax(model, [*responses.max(axis=0), *responses.mean(axis=0)])[1] - score) < 1e-4


def test_language_of_held_out_documents(spark):
    got = langid.language_of_documents(spark, SF).toPandas().set_index("doc_id")
    docs = spark.read.parquet(f"{SF}/documents.parquet").toPandas().set_index("doc_id")
    assert len(got) == len(docs)
    held = got[got.held_out]
    assert 0.15 < len(held) / len(got) < 0.35
    assert (held.lang_pred == docs.lang.loc[held.index]).mean() > 0.97
    assert got.score.between(0, 1).all()


def test_language_of_awkward_rows(spark, awkward, empty):
    rows = langid.identify(awkward)
    assert rows.columns == [*awkward.columns, "language"] and rows.count() == awkward.count()
    for r in rows.collect():
        und = r["text"] is None or not re.search(r"[^\W\d_]", r["text"])
        assert (r["language"]["lang_pred"] == "und") == und and 0 <= r["language"]["score"] <= 1
    kept = langid.of_known_language(awkward)
    assert kept.columns == awkward.columns
    assert langid.identify(empty).count() == 0
    unlabelled = spark.createDataFrame([(1, "some text", None)], "doc_id long, text string, lang string")
    assert langid.identify(unlabelled).first()["language"]["lang_pred"] == "und"


def test_the_stage_rejects_junk_and_keeps_documents(spark):
    rng = random.Random(1)
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang")
    junk = [
        "".join(rng.choice("abcdefghijklmnopqrstuvwxyz0123456789#$%&*;:<>") for _ in range(800)),
        "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/") for _ in range(900)),
        "语言是人们用来交流的系统。" * 20,
        " ".join("".join(chr(0x370 + rng.randrange(60)) for _ in range(rng.randrange(2, 9))) for _ in range(90)),
        "123 --- 456",
        None,
    ]
    rows = spark.createDataFrame([(10_000_000 + k, t, None) for k, t in enumerate(junk)], docs.schema)
    kept = {r["doc_id"] for r in langid.of_known_language(docs.unionByName(rows)).select("doc_id").collect()}
    assert kept == {r["doc_id"] for r in docs.filter(F.col("text").rlike(r"\p{L}")).select("doc_id").collect()}


def test_order_and_batches_do_not_change_a_prediction():
    rng = random.Random(2)
    texts = ["".join(rng.choice("abcdefgh ") for _ in range(n)) for n in (1, 5, 256, 257, 3000, 70_000)]
    model = langid.fit([t.encode()[:256] for t in texts] * 4, ["x", "y", "x", "y", "x", "y"] * 4, rounds=1)
    together = langid.predict(model, texts)
    alone = [langid.predict(model, [t])[0] for t in texts]
    assert [t for t, _ in together] == [t for t, _ in alone]
    assert np.allclose([s for _, s in together], [s for _, s in alone], atol=1e-5)


def auc(y, s):
    order = np.argsort(np.argsort(s)) + 1
    n = y.sum()
    return (order[y == 1].sum() - n * (n + 1) / 2) / (n * (len(y) - n))


def test_quality_of_held_out_documents(spark):
    got = quality.quality_of_documents(spark, "/root/testdata/sf0.1").toPandas()
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").toPandas()
    both = got.merge(labels, on="doc_id")
    held = both[both.held_out]
    assert auc(held.quality.to_numpy(), held.score.to_numpy()) > 0.98
    assert (held.predicted == held.quality).mean() > 0.95
    assert ((got.score >= 0.3) == (got.predicted == 1)).all() and got.score.between(0, 1).all()


def test_quality_of_awkward_rows(spark, awkward, empty):
    labels = spark.createDataFrame([(1, 1, 0), (6, 0, 0), (7, None, 0), (999, 1, 0), (8, 1, 0), (9, 0, 1)], "doc_id long, quality int, toxic int")
    model = quality.fit(*quality.labelled_sample(awkward, labels), rounds=1)
    rows = quality.with_quality(awkward, model, "q")
    assert rows.columns == [*awkward.columns, "q"]
    assert rows.count() == awkward.count() and all(0 <= r["q"] <= 1 for r in rows.collect())
    assert quality.with_quality(empty, model, "q").count() == 0
    assert quality.fit(*quality.labelled_sample(empty, labels)) == 0.5
    assert quality.fit(*quality.labelled_sample(awkward, labels.filter("quality = 1"))) == 1.0


# ---- pages


def test_boosted_trees_learn_a_rule():
    rng = np.random.default_rng(0)
    x = rng.random((4000, 5))
    y = ((x[:, 0] > 0.4) ^ (x[:, 3] > 0.7)).astype(float)
    model = boosting.fit(x[:3000], y[:3000])
    assert ((model.probability(x[3000:]) > 0.5) == y[3000:]).mean() > 0.97


def template_text(source):
    import html

    inside = re.search(r"(?s)<article>(.*?)(</article>|$)", source)[1]
    inside = re.sub(r"<br[^>]*>", " ", inside)
    blocks = re.split(r"</?(?:p|h1)\b[^>]*>", inside)
    return "\n".join(t for b in blocks if (t := " ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split())))


def test_main_text_of_all_pages(spark):
    source = {r["page_id"]: r["html"] for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    for r in pages.main_text_of_pages(spark, SF).collect():
        assert r["text"] == template_text(source[r["page_id"]]) and r["n_chars"] == len(r["text"])


def test_pages_of_other_templates(spark):
    sample = [r["html"] for r in spark.read.parquet("/root/testdata/sf0.1/pages.parquet").limit(400).collect()]
    model = pages.fit_nodes(sample)
    prose = "The article has long sentences, with commas, and says a lot about one thing. " * 6
    page = f"""<html><head><title>T</title></head><body><div class='menu'><a href=1>Home</a> <a href=2>About</a></div>
      <main><h1>A title &amp; more</h1><p>{prose}<p>Second,&#32; {prose}<ul><li>point one of the article, with words<li>point two</ul>
      <aside>See also: <a href=3>other</a></aside><form><input name=q><button>Go</button>Search</form></main>
      <section class="comments"><p>Great post, thanks a lot for it!</p></section><div id=cookie-notice>We use cookies</div>
      <script>var x = "<p>no</p>";</script><style>p {{ color: red }}</style><footer>&copy; 2024</footer></body></html>"""
    text = pages.main_text(model, page).split("\n")
    flat = " ".join(prose.split())
    assert text[:3] == ["A title & more", flat, f"Second, {flat}"]
    assert "point two" in text
    joined = "\n".join(text)
    assert not any(w in joined for w in ("Home", "See also", "Search", "Great post", "cookies", "no</p>", "color", "©", "Go"))


WRAPPED = [
    "<body class='no-sidebar'>{nav}<article>{a}</article>{end}</body>",
    "<body>{nav}<div class='has-sidebar'><article>{a}</article>{aside}</div>{end}</body>",
    "<body>{nav}<main class='content comments-open'>{a}</main>{end}</body>",
    "<body>{nav}<div class='search results'><main>{a}</main></div>{end}</body>",
    "<body><form id='aspnetForm'>{nav}<article>{a}</article>{end}</form></body>",
    "<body><form>{nav}<div class='post'>{a}</div>{end}</form></body>",
    "<body>{nav}<div class='has-sidebar'><div class='post'>{a}</div></div>{end}</body>",
    "<body>{nav}{long}<div class='has-sidebar'><article>{a}</article></div>{end}</body>",
    "<body>{nav}<article>{a}</article>{long}{end}</body>",
]


def test_named_wrappers_keep_the_article(spark):
    sample = [r["html"] for r in spark.read.parquet("/root/testdata/sf0.1/pages.parquet").limit(400).collect()]
    model = pages.fit_nodes(sample)
    prose = " ".join(f"The article has a long sentence, number {k}, and says much about one thing." for k in range(8))
    parts = {
        "a": f"<h1>A title</h1><p>{prose}</p><p>More. {prose}</p>",
        "nav": "<nav><a href=1>Home</a> <a href=2>About</a></nav>",
        "aside": "<aside><a href=3>See also</a></aside>",
        "end": "<footer>Copyright 2024</footer>",
        "long": "<div id='comments'>" + "".join(f"<div class='comment'><p>Remark {k}. {prose}</p></div>" for k in range(4)) + "</div>",
    }
    for template in WRAPPED:
        page = f"<html><head><title>T</title></head>{template.format(**parts)}</html>"
        assert pages.main_text(model, page) == f"A title\n{prose}\nMore. {prose}", template
        labels = pages.weak_labels(pages.parse(page))
        assert (labels == 1).any() or "post" in template, template


SHELLS = [
    "<!DOCTYPE html><html lang=en><head><title>T</title></head><body>{}</body></html>",
    "<body>{}</body>",
    "<html>{}</html>",
    "<!DOCTYPE html><title>T</title>{}",
    "{}",
    "<html><body><div>{}</div></body></html>",
    "<div>{}</div>",
    "<html><body><div><div><div>{}</div></div></div></body></html>",
    "<div id=x><div><div>{}</div></div></div>",
]


def test_the_shell_of_a_page_changes_nothing(spark):
    given = [r["html"] for r in spark.read.parquet("/root/testdata/sf0.1/pages.parquet").limit(460).collect()]
    model = pages.fit_nodes(given[:400])
    prose = " ".join(f"The article has a long sentence, number {k}, and says much about one thing." for k in range(8))
    parts = {
        "a": f"<h1>A title</h1><p>{prose}</p><p>More. {prose}</p>",
        "nav": "<nav><a href=1>Home</a> <a href=2>About</a></nav>",
        "aside": "<aside><a href=3>See also</a></aside>",
        "end": "<footer>Copyright 2024</footer>",
        "long": "<div id='comments'>" + "".join(f"<div class='comment'><p>Remark {k}. {prose}</p></div>" for k in range(4)) + "</div>",
    }
    inner = [(re.sub("^<body[^>]*>|</body>$", "", t).format(**parts), f"A title\n{prose}\nMore. {prose}") for t in WRAPPED]
    for source in given[400:]:
        body = re.search(r"(?s)<body[^>]*>(.*?)(</body>|$)", source)[1]
        inner.append((body, template_text(source)))
    for shell in SHELLS:
        got = pages.main_texts(model, [shell.format(body) for body, _ in inner])
        assert got == [want for _, want in inner], shell


def test_pages_that_say_nothing_are_not_empty(spark):
    model = pages.fit_nodes([r["html"] for r in spark.read.parquet("/root/testdata/sf0.1/pages.parquet").limit(400).collect()])
    prose = "Some words stand here, one after another, and say something about a thing. " * 5
    for page, want in {
        "plain text only": "plain text only",
        prose: prose.strip(),
        f"<p>{prose}": prose.strip(),
        f"<div><div><p>{prose}</p></div></div>": prose.strip(),
        "<p>x": "x",
        "<script>x</script>": "",
    }.items():
        assert pages.main_text(model, page) == want, page


def test_unclosed_elements_are_read_in_one_pass():
    import time

    start = time.perf_counter()
    for tag in ("button", "select", "canvas", "svg", "object"):
        page = pages.parse(f"<{tag}>word " * 150_000)
        assert sum(map(len, page.blocks)) > 0
    assert time.perf_counter() - start < 60


def best_choices(page, chance):
    """All consistent choices of a page with their log chance: [(score, kept blocks)]."""
    yes, no = np.log(np.clip(chance, 0.01, 0.99)), np.log(1 - np.clip(chance, 0.01, 0.99))

    def holds(k):
        return bool(page.nodes[k].blocks) or any(holds(c) for c in page.nodes[k].children)

    def below(k):
        return [k, *[x for c in page.nodes[k].children for x in below(c)]]

    def choices(k):
        if not holds(k):
            return [(0.0, [])]
        mine = [x for x in below(k) if holds(x)]
        found = [(sum(yes[x] for x in mine), [b for x in mine for b in page.nodes[x].blocks]), (sum(no[x] for x in mine), [])]
        return found + opened(k, -pages.OPENING)

    def opened(k, score):
        own = page.nodes[k].blocks
        found = [(score + (max(yes[k], no[k]) if own else 0), list(own) if own and chance[k] >= 0.5 else [])]
        for c in page.nodes[k].children:
            found = [(a + b, x + y) for a, x in found for b, y in choices(c)]
        return found

    return opened(0, 0.0)


def test_decoding_finds_the_likeliest_consistent_choice():
    rng = np.random.default_rng(12)
    sources = ["<div>a<p>b</p><section><p>c</p><p>d</p></section></div><p>e</p>", "x<ul><li>a<li>b</ul>y<div><div><p>c</p>d</div></div>", "<p>a</p><div></div>"]
    for source in sources:
        page = pages.parse(source)
        for _ in range(60):
            chance = rng.random(len(page.nodes))
            best = max(best_choices(page, chance))
            kept = pages.decode(page, chance)
            assert any(abs(score - best[0]) < 1e-9 and sorted(blocks) == kept for score, blocks in best_choices(page, chance))


def test_decoding_is_consistent():
    rng = np.random.default_rng(4)
    page = pages.parse("<div>" + "".join(f"<section><p>a{k}</p><div><p>b{k}</p></div></section>" for k in range(20)) + "</div>")
    for _ in range(20):
        kept = pages.decode(page, rng.random(len(page.nodes)))
        assert kept == sorted(set(kept))
    assert pages.decode(page, np.full(len(page.nodes), 0.9)) == list(range(40))
    assert pages.decode(page, np.full(len(page.nodes), 0.1)) == []


def test_awkward_pages(spark):
    rows = [
        (1, "u", None), (2, "u", ""), (None, None, "<p>x"), (3, "u", "<" * 5000), (3, "u", "<" * 5000), (4, "u", "<div>" * 5000 + "deep" + "</div>" * 5000),
        (5, "u", "plain text only"), (6, "u", "<!-- unclosed"), (7, "u", "<script>never closed"), (8, "u", "<a href='" + "x" * 100_000), (9, "u", "<b>" * 3000 + "t"),
    ]
    source = spark.createDataFrame([(*r, "other") for r in rows], "page_id long, url string, html string, text string")
    got = pages.extract_main_text(source)
    assert got.columns == ["page_id", "url", "html", "text"] and got.count() == len(rows)
    assert {r["page_id"]: r["text"] for r in got.collect()}[1] == ""
    assert pages.extract_main_text(source.limit(0)).count() == 0


# ---- personal data


PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_spans(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            d = re.sub(r"[^0-9]", "", m.group())
            doubled = [int(c) if k % 2 == 0 else sum(map(int, str(2 * int(c)))) for k, c in enumerate(reversed(d))]
            good = {
                "email": lambda: True,
                "ip": lambda: all(int(p) <= 255 for p in m.group().split(".")),
                "card": lambda: 13 <= len(d) <= 19 and sum(doubled) % 10 == 0,
                "phone": lambda: 9 <= len(d) <= 15,
            }[kind]()
            if good:
                out.append((kind, m.start(), m.end()))
    return out


def test_base_spans_equal_the_patterns():
    rng = random.Random(9)
    alphabet = ["1", "4", "25", "255", ".", ".", "-", " ", "+", "(", ")", "@", "a", "b.c", "é", "%", "\n", "4111111111111111", "@x.y", "10.0.0.1", "+1 (555) 123-4567", "0" * 25, "00"]
    for _ in range(4000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(30)))
        assert sorted(pii.base_spans(text)) == sorted(plain_spans(text)), text


def plain_reliabilities(patterns, rounds=100):
    """Expectation-maximisation over (kind, votes, count), loop by loop; chance of each pattern."""
    chance = [(sum(v == 1 for v in votes) + 0.5) / (sum(v >= 0 for v in votes) + 1) for _, votes, _ in patterns]
    for _ in range(rounds):
        prior = {}
        for kind in range(len(pii.KINDS)):
            mine = [(c, n) for c, (k, _, n) in zip(chance, patterns) if k == kind]
            prior[kind] = (sum(c * n for c, n in mine) + 1) / (sum(n for _, n in mine) + 2)
        tables = {}
        for truth in (0, 1):
            for labeler in range(len(pii.LABELERS)):
                sums = [1 + sum((c if truth else 1 - c) * n for c, (_, v, n) in zip(chance, patterns) if v[labeler] == vote) for vote in (-1, 0, 1)]
                tables[truth, labeler] = [s / sum(sums) for s in sums]
        for labeler in range(len(pii.LABELERS)):
            tables[1, labeler][2] = max(tables[1, labeler][2], tables[0, labeler][2])
            tables[0, labeler][1] = max(tables[0, labeler][1], tables[1, labeler][1])
        new = []
        for kind, votes, _ in patterns:
            odds = np.log(prior[kind] / (1 - prior[kind]))
            for labeler, vote in enumerate(votes):
                odds += np.log(tables[1, labeler][vote + 1] / sum(tables[1, labeler])) - np.log(tables[0, labeler][vote + 1] / sum(tables[0, labeler]))
            new.append(1 / (1 + np.exp(-odds)))
        if max(abs(a - b) for a, b in zip(new, chance)) < 1e-9:
            break
        chance = new
    return chance


def test_reliabilities_equal_plain_loops():
    rng = random.Random(3)
    for _ in range(5):
        patterns = list({(rng.randrange(4), tuple(rng.choice([-1, 0, 1]) for _ in pii.LABELERS)): rng.randrange(1, 50) for _ in range(30)}.items())
        patterns = [(k, v, n) for (k, v), n in patterns]
        got = pii.reliabilities(np.array([k for k, _, _ in patterns]), np.array([v for _, v, _ in patterns]), np.array([n for *_, n in patterns], float))[0]
        assert np.allclose(got, plain_reliabilities(patterns), atol=1e-7)


def test_added_spans_equal_a_plain_choice():
    rng = random.Random(11)
    pieces = ["call 555-123-4567", "a at b dot com", "mail x@y.org", "10.0.0.300", "4111 1111 1111 1112", "version 1.2.3.4", "+1 555 123 4567", "text", "tel 0301234567", "."]
    weights = np.random.default_rng(2).normal(size=len(pii.KINDS) + 2 * len(pii.LABELERS) + 6 + 1)
    for _ in range(200):
        found = pii.spans_of(" ".join(rng.choice(pieces) for _ in range(8)))
        taken = [(int(s["kind"]), int(s["start"]), int(s["stop"])) for s in found if s["base"]]
        more = [s for s in found if not s["base"]]
        scored = []
        for s in more:
            row = pii.span_features(np.array([int(s["kind"])]), s["votes"][None], s["shape"][None])[0]
            scored.append((-float(sum(a * b for a, b in zip(row, weights))), int(s["start"]), s))
        for minus, _, s in sorted(scored, key=lambda x: x[:2]):
            clear = all(int(s["stop"]) <= a or b <= int(s["start"]) for _, a, b in taken)
            if clear and -minus >= np.log(pii.THRESHOLD / (1 - pii.THRESHOLD)):
                taken.append((int(s["kind"]), int(s["start"]), int(s["stop"])))
        assert pii.chosen_spans(found, weights) == [(pii.KINDS[k], a, b) for k, a, b in sorted(taken)]


def test_query_of_personal_data(spark):
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = pii.personal_data_of_documents(spark, SF).collect()
    assert len(rows) == len(docs)
    for r in rows:
        base = plain_spans(docs[r["doc_id"]])
        line = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        assert r["base_sha256"] == hashlib.sha256(line.encode()).hexdigest()
        assert [r[f"n_{k}"] for k in PATTERNS] == [sum(s[0] == k for s in base) for k in PATTERNS]
        spans = [s for s in r["spans"].split(",") if s]
        assert {f"{k}:{a}:{b}" for k, a, b in base} <= set(spans)
        order = [(list(PATTERNS).index(s.split(":")[0]), int(s.split(":")[1])) for s in spans]
        assert order == sorted(order)


def test_unsure_labelers_lose_weight(spark):
    """One labeler is right, one votes at random: the estimates tell them apart."""
    rng = random.Random(1)
    votes, counts = {}, None
    for _ in range(4000):
        truth = rng.random() < 0.6
        right = truth if rng.random() < 0.95 else not truth
        pattern = (int(right), int(truth if rng.random() < 0.9 else not truth), rng.randrange(2), -1, -1, int(truth if rng.random() < 0.85 else not truth))
        votes[pattern] = votes.get(pattern, 0) + 1
    patterns = np.array(list(votes))
    counts = np.array(list(votes.values()), float)
    chance, prior, tables = pii.reliabilities(np.zeros(len(votes), int), patterns, counts)
    assert tables[1, 0, 2] > 0.85 and tables[0, 0, 1] > 0.85
    assert abs(tables[1, 2, 2] - tables[0, 2, 2]) < 0.15
    assert abs(prior[0] - 0.6) < 0.1 and (chance[(patterns[:, 0] == 1) & (patterns[:, 1] == 1)] > 0.5).all()


def test_personal_data_of_awkward_rows(spark, awkward, empty):
    more = spark.createDataFrame(
        [(500, "Call my phone: (555) 123-4567 now, mail joe at example dot com"), (501, "1" * 20_000), (502, "@" * 20_000), (503, "1.2." * 8000), (504, None)],
        "doc_id long, text string",
    )
    rows = pii.personal_spans(more).withColumn("spans", pii.span_array(F.col("spans"))).collect()
    assert len(rows) == 5 and all(s["start"] < s["stop"] for r in rows for s in r["spans"])
    assert pii.personal_spans(awkward).count() == awkward.count()
    assert pii.personal_spans(empty).count() == 0


def test_fold_of_null_ids(awkward):
    assert awkward.filter(langid.in_fold(F.col("doc_id"), 4, 2).isNull()).count() == 0
