"""Language, toxicity, benchmark leaks and page text."""

import random

import numpy as np
import pytest
import regex
import zstandard

from brute import DOCS
from strata.llm import decontaminate, language, pages, toxicity
from strata.llm.blocks import table_path

# --- language


def test_dictionaries_are_bounded(spark):
    rows = [(i, "en" if i % 3 else "de", f"some words {i} " * 400) for i in range(600)]
    found = language.learn_dictionaries(spark.createDataFrame(rows, "doc_id long, lang string, text string"), pieces=8, piece_bytes=100)
    assert list(found) == ["en", "de"]
    assert all(len(d) <= 8 * 101 for d in found.values())


def test_language_of_held_out_documents(spark):
    documents = spark.read.parquet(table_path(DOCS, "documents").replace("sf0.001", "sf0.01"))
    learned = language.learn_dictionaries(documents.where(language.crc_class("doc_id", 5) != 0))
    held = documents.where(language.crc_class("doc_id", 5) == 0)
    rows = language.identify(held, learned, keep=("doc_id", "lang")).collect()
    assert len(rows) == held.count()
    assert np.mean([r["lang"] == r["lang_pred"] for r in rows]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_by_direct_compression(spark):
    documents = spark.read.parquet(table_path(DOCS, "documents"))
    learned = language.learn_dictionaries(documents.where(language.crc_class("doc_id", 5) != 0))
    found = {r["doc_id"]: r["lang_pred"] for r in language.identify(documents, learned).collect()}
    for row in documents.select("doc_id", "text").collect():
        body = language.plain(row["text"] or "")
        if not regex.search(r"\p{L}", row["text"] or ""):
            assert found[row["doc_id"]] == "und"
            continue
        sizes = {}
        for name, content in learned.items():
            dictionary = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            sizes[name] = sum(
                len(zstandard.ZstdCompressor(level=language.LEVEL, dict_data=dictionary, write_content_size=False, write_checksum=False, write_dict_id=False)
                    .compress(body[i : i + language.BLOCK])) for i in range(0, len(body), language.BLOCK))
        assert sizes[found[row["doc_id"]]] == min(sizes.values())


def test_language_of_odd_rows(odd, odd_rows, none):
    learned = language.learn_dictionaries(odd.where("lang IS NOT NULL"))
    found = language.identify(odd, learned).collect()
    assert len(found) == len(odd_rows)
    by_id = {r["doc_id"]: r for r in found}
    for i in (4, 5, 6):
        assert (by_id[i]["lang_pred"], by_id[i]["score"], by_id[i]["rejected"]) == ("und", 0.0, True)
    assert by_id[9]["lang_pred"] == "de"
    assert all(r["lang_pred"] in {"en", "fr", "de", "und"} for r in found)
    assert all(r["lang_pred"] == "und" for r in language.identify(odd, {}).collect())
    assert language.identify(none, learned).collect() == []
    assert language.learn_dictionaries(none) == {}


# --- toxicity


def edits_of(word):
    letters = "abcdefghijklmnopqrstuvwxyz"
    out = {word}
    for i in range(len(word) + 1):
        out |= {word[:i] + c + word[i:] for c in letters}
        if i < len(word):
            out |= {word[:i] + word[i + 1 :]} | {word[:i] + c + word[i + 1 :] for c in letters}
            if i + 1 < len(word):
                out.add(word[:i] + word[i + 1] + word[i] + word[i + 2 :])
    return out


def run(automaton, word):
    place = {c: i for i, c in enumerate(automaton.letters)}
    state = np.ones(1, np.int64)
    for c in word:
        state = automaton.next(state, np.array([place.get(c, len(place))])).astype(np.int64)
    return int(automaton.kind[state[0]])


def test_automaton_knows_all_single_edits():
    words = ["stupid", "idiot", "scum", "loser", "losers"]
    automaton = toxicity.Automaton(words)
    near = set().union(*(edits_of(w) for w in words if len(w) >= toxicity.FUZZY_LENGTH))
    for word in near | set(words):
        assert run(automaton, word) == (1 if word in words else 2), word
    chance = random.Random(5)
    for _ in range(3000):
        word = "".join(chance.choice("stupidolercmz") for _ in range(chance.randint(1, 8)))
        assert run(automaton, word) == (1 if word in words else 2 if word in near else 0), word


@pytest.fixture(scope="module")
def abuse(spark):
    chance = random.Random(7)
    rows, labels = [], []
    for i in range(400):
        words = [f"{chance.choice('bdfgklmnp')}{chance.choice('aeiou')}{chance.choice('rstln')}{chance.choice('aeiou')}" for _ in range(40)]
        toxic = i % 4 == 0
        if toxic:
            words[chance.randrange(40)] = chance.choice(["idiot", "Stupid", "loser,"])
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    labels += [(0, 0), (None, 1), (399, None)]
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_toxicity(spark, abuse, odd, odd_rows, none):
    documents, labels = abuse
    model = toxicity.learn(toxicity._labelled(documents, labels, "doc_id", "text", "toxic"))
    new = [
        (1, "you are an idiot and so on"), (2, "you are an idoit and so on"), (3, "you are a stupidd one"), (4, "a fine day for all"),
        (5, 'the word "idiot" is a word'), (6, ""), (7, None), (8, "IDIOT! " + "word " * 5000),
    ]
    rows = {r["doc_id"]: r for r in toxicity.score(spark.createDataFrame(new, "doc_id long, text string"), model).collect()}
    assert rows[1]["score"] > 0.9 and rows[1]["n_words"] == 1
    assert rows[2]["n_misspelt"] == 1 and rows[3]["n_misspelt"] == 1
    assert rows[4]["score"] < 0.1 and rows[6]["score"] < 0.1 and rows[6]["score"] == rows[7]["score"]
    assert (rows[5]["n_words"], rows[5]["n_quoted_words"]) == (0, 1) and rows[5]["score"] < 0.3
    assert rows[8]["n_words"] == 1
    assert len(toxicity.score(odd, model).collect()) == len(odd_rows)
    assert toxicity.score(none, model).collect() == []


def test_words_of_any_spelling_and_length():
    matcher = toxicity.Matcher(toxicity.Lexicon(["idiot", "e-idiot", "xy" * 30], frozenset({"idiom"})))
    kinds = lambda text: sorted(matcher.matches([text])[1].tolist())
    for text in ("idiot...and", "idiot/moron", "an idiot's", "IDIOOOT", "idiooottt", "(idiot)", "a" * 60 + ".idiot", "e-idiot", "xy" * 30):
        assert kinds(text) == [1], text
    for text in ("jdiot", "xidiot", "diot", "id-iot", "idioot", "diiot/x"):
        assert kinds(text) == [2], text
    for text in ("idiom", "idioms", "an id iot", "", "...", "xy" * 500):
        assert kinds(text) == [], text
    row, kind, quoted, counts = matcher.matches(["", 'so "idiot" he', "aaa idiot bbb", "\n"])
    assert (row.tolist(), kind.tolist(), quoted.tolist(), counts.tolist()) == ([1, 2], [1, 1], [1, 0], [0, 3, 3, 0])


def test_table_begins_anew(monkeypatch):
    matcher = toxicity.Matcher(toxicity.Lexicon(["idiot", "loser"], frozenset()))
    monkeypatch.setattr(toxicity, "MOST_STATES", 4)
    for _ in range(3):
        assert matcher.matches(["idiot looser jdiot fine"])[1].tolist() == [1, 2, 2]


def test_many_terms_are_all_learned(spark):
    terms = [f"{a}{b}{c}zqv" for a in "bcdfghjklm" for b in "aeiou" for c in "bcdfghjklmnp"]
    rows = [(i, f"some words {i % 7} and {terms[i % 600]} too" if i < 12000 else f"some words {i % 7} and more too") for i in range(36000)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    labels = frame.selectExpr("doc_id", "CAST(doc_id < 12000 AS int) AS toxic")
    lexicon, weights, _ = toxicity.learn(toxicity._labelled(frame, labels, "doc_id", "text", "toxic"))
    assert len(terms) == 600 and set(terms) <= set(lexicon.words)
    found = toxicity.Matcher(lexicon).matches([" ".join(terms)])
    assert found[1].tolist() == [1] * 600


def test_toxicity_without_labels(none, odd, abuse):
    model = toxicity.learn(toxicity._labelled(none, abuse[1], "doc_id", "text", "toxic"))
    assert {r["score"] for r in toxicity.score(odd, model).collect()} == {0.1}


# --- benchmark leaks


def edited(text, chance, edits):
    letters = list(text)
    for _ in range(edits):
        at = chance.randrange(len(letters))
        kind = chance.randrange(3)
        letters[at : at + 1] = [] if kind == 0 else [chance.choice("aeiou")] if kind == 1 else [letters[at], chance.choice("xyz")]
    return "".join(letters)


def brute_distance(item, text):
    """Least edits of the item against any part of the text."""
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            new.append(min(row[j - 1] + (a != b), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def test_leaks_with_edits(spark):
    chance = random.Random(11)
    make = lambda n: " ".join("".join(chance.choice("abcdefghiklmnoprstuvw") for _ in range(chance.randint(2, 9))) for _ in range(n))
    items = [(i, make(n)) for i, n in enumerate((12, 20, 35, 50, 20))] + [(9, None), (10, "short"), (None, make(20)), (11, "")]
    rows, want = [], {}
    for d in range(60):
        i = d % 5
        item = items[i][1]
        edits = chance.choice((0, 0, 1, len(item) // 20, len(item) // 11, len(item) // 4))
        text = make(30) + " " + edited(item, chance, edits).upper().replace(" ", "  \n") + " " + make(30)
        rows.append((d, text))
        plain = " ".join(text.lower().split())
        want[d] = sorted(
            k for k, t in items if k is not None and t and len(t) >= decontaminate.Q
            and brute_distance(t, plain) <= min(len(t) // 10, (len(t) - decontaminate.Q) // decontaminate.Q))
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    for size in (decontaminate.INDEX_BYTES, 200):  # one index, and several
        found = {r["doc_id"]: r["leaks"] for r in decontaminate.find_leaks(documents, benchmark, index_bytes=size).collect()}
        assert {d: sorted(h["item_id"] for h in hits) for d, hits in found.items()} == want
        for d, hits in found.items():
            body = rows[d][1].encode()
            for hit in hits:
                part = " ".join(body[hit["start"] : hit["end"]].decode().lower().split())
                assert brute_distance(part, dict(items)[hit["item_id"]]) <= 2 * len(part) // 10 + 2


def test_leaks_of_documents(spark):
    documents = spark.read.parquet(table_path(DOCS, "documents")).select("doc_id", "text")
    benchmark = spark.read.parquet(table_path(DOCS, "benchmark"))
    plain = lambda t: " ".join(t.lower().split())
    items = {r["item_id"]: plain(r["text"]) for r in benchmark.collect()}
    found = {r["doc_id"]: {h["item_id"] for h in r["leaks"]} for r in decontaminate.find_leaks(documents, benchmark).collect()}
    for row in documents.collect():
        text = plain(row["text"])
        assert {i for i, t in items.items() if t in text} <= found[row["doc_id"]]
    assert sum(map(bool, found.values())) < len(found) / 4


def test_leaks_of_odd_rows(spark, odd, odd_rows, none):
    benchmark = spark.createDataFrame([(1, "passage3 passage4 passage5 passage6 passage7")], "item_id long, text string")
    found = decontaminate.find_leaks(odd, benchmark).collect()
    assert len(found) == len(odd_rows)
    assert sorted(r["doc_id"] for r in found if r["leaks"]) == [10, 11]
    assert all(not r["leaks"] for r in decontaminate.find_leaks(odd, benchmark.limit(0)).collect())
    assert decontaminate.find_leaks(none, benchmark).collect() == []


# --- pages

PAGE = """<!DOCTYPE html><html><head><title>T {n}</title><style>p{{}}</style><script>var a="</p>";</script></head><body>
<header class="site-header"><a href="/">Home</a></header><nav><ul><li><a href=1>One</a></li><li><a href=2>Two</a></li></ul></nav>
<div class="ad">Buy {n}</div><{box}><h1>Title {n} &amp; more</h1>{paragraphs}</{box2}>
<aside>Related {n}</aside><section class="comments"><p>First! {n}</p></section><form><input><p>Sign up</p></form>
<footer>&copy; site {n}</footer></body></html>"""


def page(n, box, box2):
    text = "".join(f"<p>Paragraph {i} of\n  <b>page</b> {n} with  words&nbsp;enough.</p>" for i in range(n + 1))
    return PAGE.format(n=n, box=box, box2=box2, paragraphs=text)


def article(n):
    return "\n".join([f"Title {n} & more", *(f"Paragraph {i} of page {n} with words enough." for i in range(n + 1))])


@pytest.mark.parametrize("box, box2", [("article", "article"), ("div class='post-content'", "div"), ("div id=x", "div")])
def test_articles(spark, box, box2):
    rows = [(n, f"https://www.Example.org/{n}", page(n, box, box2)) for n in range(6)]
    found = {r["page_id"]: r["text"] for r in pages.extract(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()}
    assert found == {n: article(n) for n in range(6)}


def test_wrapper_of_a_host(spark):
    rows = [(n, "http://h.example/a", f"<ul>{'<li>x</li>' * (n + 1)}</ul>{'<hr><i>y</i><div>z</div>' if n % 2 else ''}<p>{n}</p>") for n in range(4)]
    wrapper = pages.infer_wrappers(spark.createDataFrame(rows, "page_id long, url string, html string")).first()["wrapper"]
    assert wrapper.split() == "<ul (<li # /li)+ /ul #? <div? #? /div? <p # /p".split() or "(<li # /li)" in wrapper


def test_forms_are_read_back():
    form = pages.align(pages.fold("<a # /a <a # /a <b".split()), pages.fold("<c <a # /a".split()))
    assert pages.read_form(pages.write_form(form)) == form


def test_template_texts_inside_articles(spark):
    make = lambda n: (
        f"<article><h1>Title {n}</h1><div>All rights kept here</div><p>Body {n} of words</p><p>More {n} of words</p><div>Own {n} end</div>"
        f"<ul><li><a href=1>Read {n}</a></li><li><a href=2>See {n}</a></li></ul><article><p>Reply {n}</p></article><p>Sent from this site</p></article>")
    rows = [(n, f"http://t.example/{n}", make(n)) for n in range(6)] + [(9, "http://u.example/", "<article><p>Same</p></article>")] * 5
    found = {r["page_id"]: r["text"] for r in pages.extract(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)).collect()}
    assert found == {n: f"Title {n}\nBody {n} of words\nMore {n} of words\nOwn {n} end" for n in range(6)} | {9: "Same"}


def test_each_page_is_decided_on_its_own(spark):
    make = lambda n, box, box2: f"<nav><a href=1>Home</a></nav><{box}><p>Body {n} of some words</p><p>More {n}</p></{box2}><div class='entry-meta'>By {n}</div>"
    boxes = [("article", "article"), *[(f"div id='node-{n}'", "div") for n in range(1, 5)], ("section id=my-own-slug", "section"), ("div class='x'", "div")]
    rows = [(n, f"http://v.example/{n}", make(n, *box)) for n, box in enumerate(boxes)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    assert {r["page_id"]: r["text"] for r in pages.extract(frame).collect()} == {n: f"Body {n} of some words\nMore {n}" for n in range(7)}
    assert "node" not in pages.infer_wrappers(frame).first()["wrapper"]


def test_pages_match_their_wrapper():
    forms = [pages.fold(x.split()) for x in ("<a # /a <a # /a <b # /b", "<c <a # /a <b # /b <b # /b", "<b # /b")]
    wrapper = forms[0]
    for form in forms[1:]:
        wrapper = pages.align(wrapper, form)
    for form in forms:
        assert [pages._unit(wrapper[j]) for j in pages.match(form, wrapper)] == [pages._unit(i) for i in form]


def test_odd_pages(spark):
    rows = [(1, "http://a.org/1", None), (2, None, "<p>text"), (3, "nonsense", ""), (4, "http://a.org/2", "<article><p>open <b>text<br><p>next &am</article>"),
            (4, "http://a.org/2", "<article><p>open <b>text<br><p>next &am</article>"), (None, "", "plain"), (6, "http://a.org/3", "<!-- cut"), (7, "http://b.org/", "<article>" + "<p>long</p>" * 20000)]
    found = pages.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()
    assert len(found) == len(rows)
    texts = {r["page_id"]: r["text"] for r in found}
    assert texts[1] == texts[3] == texts[6] == ""
    assert texts[4] == "open text\nnext &am" and texts[2] == "text" and texts[None] == "plain"
    assert texts[7].count("long") == 20000
    assert pages.extract(spark.createDataFrame([], "page_id long, url string, html string")).collect() == []


LAYOUTS = {
    "body": ("<body class='right-sidebar has-menu'>", "", "", "</body>"),
    "html": ("<html class='no-search widget'><body>", "", "", "</body></html>"),
    "form": ("<body><form id='aspnetForm'>", "", "", "</form></body>"),
    "widget": ("<body>", "<div class='elementor-widget elementor-widget-text'>", "</div>", "</body>"),
    "column": ("<body>", "<div class='column with-side'>", "</div>", "</body>"),
    "table": ("<body>", "<article><div class='table-responsive'>", "</div></article>", "</body>"),
    "figure": ("<body>", "<article><figure><img src=x><figcaption>A view</figcaption></figure>", "</article>", "</body>"),
    "headed": ("<body>", "<article><div class='post-header'><h1>Its title</h1></div>", "</article>", "</body>"),
}


@pytest.mark.parametrize("n_pages", [1, 5])
def test_layout_named_like_boilerplate_holds_the_article(spark, n_pages):
    rows, expected = [], {}
    for at, (kind, (opened, inner, closed, end)) in enumerate(LAYOUTS.items()):
        for n in range(n_pages):
            own = "\n".join(f"Paragraph {i} of page {n} has words of its own, number {n * 31 + i}." for i in range(4))
            body = "".join(f"<p>{line}</p>" for line in own.split("\n"))
            html = (f"{opened}<nav><a href=1>Home</a></nav>{inner}{body}{closed}<div class='sidebar'><p>Beside {n}</p></div>"
                    f"<div class='comments'><p>Said {n}</p></div><form><p>Your name {n}</p></form><footer>Foot</footer>{end}")
            lead = {"figure": "A view\n", "headed": "Its title\n"}.get(kind, "")
            rows.append((100 * at + n, f"http://{kind}.example/{n}", html, "x", 1, "h"))
            expected[100 * at + n] = lead + own
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, text string, __slots long, host string")
    found = {r["page_id"]: r["text"] for r in pages.extract(frame).collect()}
    if n_pages > 1:  # the same on each page of a host
        expected = {i: t.replace("A view\n", "").replace("Its title\n", "") for i, t in expected.items()}
    assert found == expected


def test_words_of_layout_do_not_hide_short_articles():
    shown = ["body@0/div.sidebar@1/#@2", "body@0/article@3/p@4/#@5", "body@0/div.comments@6/p@7/#@8"]
    assert pages.below_boilerplate(shown, ["s" * 60, "a" * 40, "c" * 900], [0, 0, 0]) == [True, False, True]
    assert pages.below_boilerplate(shown, ["s" * 960, "a" * 40, "c" * 900], [0, 0, 0]) == [False, False, True]
