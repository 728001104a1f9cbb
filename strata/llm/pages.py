"""Main text of web pages through wrappers inferred for each host.

A page is a stream of tags and texts. Its form is that stream with every tandem repeat folded into
a repeated group, until none is left. The forms of a host are aligned one after the other, in order:
what only one of two has becomes optional, a part that one has once and the other repeated becomes
repeated, and differing texts are slots. The result, the host's wrapper, is a regular expression
without unions. Every page's form is then matched with its host's wrapper, so that each text lies in
a slot: the item of the wrapper that holds it, and the items that opened the elements around it. In
a slot the first and the last text of a page are told from those between.

Over all pages of the host it is counted for each slot how long its texts are, how much of them are
links and whether they ever differ. A text is no part of an article where its slot is mostly links, where
it is the one text that the slot has on at least ``VARIETY`` pages that are not near copies, or in an
article inside another (the markup's element for comments).

The article is the rest of what lies below an article or main element, or else, where they hold a good part of
the page, below elements whose class, id or role names one, or else below the element with most text of the host
that holds a good part of the page, or else below the page's own largest. Every page is decided on its own. Slots below
navigation, headers, footers, asides, forms and the like, by element or by class, id or role,
are left out; such words on ``html`` and ``body`` say nothing, and forms and words of layout nothing on an
element that holds the page (``below_boilerplate``). Comments and related texts that are neither links nor named in one of these ways stay.

Each page is parsed once. A wrapper is aligned from the distinct forms of a host, dealt by their hash, so
that a hot host has many groups and the result does not depend on the partitioning.

Defined results: null or empty html gives an empty text; a null url or one without a host
belongs to the host ''; unclosed and unknown tags are read as they come; each input row gives one
output row, repeated or not; an empty table gives an empty table. Other columns are not needed.
"""

from __future__ import annotations

import functools
import html as html_entities
import re
from collections.abc import Iterator
from typing import NamedTuple

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, LongType, StringType

from strata.llm.blocks import slices, table_path
from strata.workspace import materialize

TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*>?"
    r"|<(script|style|template|noscript|textarea|svg|iframe)\b[^>]*>.*?(?:</\1\s*>|$)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>?", re.S | re.I)
ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
# Elements of the markup language.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set("a abbr b bdi bdo cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr img".split())
SECTIONS = set("p li dt dd tr td th option h1 h2 h3 h4 h5 h6".split())  # closed by the next of their kind
CONTAINERS = set("article main section div body table ul ol dl nav aside header footer form blockquote".split())
BOILERPLATE = set("nav aside footer form head title button select dialog menu label option fieldset legend object".split())
# what the words of a class, id or role say: the first are of whole elements that are no article, the
# second are also given to layout that holds the article
FIXED_HINTS = re.compile(
    r"(?:^|[^a-z])(?:ad|ads|adv|advert\w*|banner\w*|breadcrumb\w*|cookie\w*|comment\w*|consent\w*|disqus|footer\w*|gdpr|"
    r"newsletter\w*|pager|pagination|popup\w*|promo\w*|recommend\w*|related\w*|repl(?:y|ies)|respond|responses?|sponsor\w*|contentinfo)(?:$|[^a-z])")
HINTS = re.compile(
    r"(?:^|[^a-z])(?:ad|ads|adv|advert\w*|banner\w*|breadcrumb\w*|bottom\w*|cookie\w*|comment\w*|consent\w*|disqus|footer\w*|form|gdpr|"
    r"header\w*|login|masthead|menu\w*|modal|nav\w*|newsletter\w*|notice\w*|pager|pagination|popup\w*|promo\w*|recommend\w*|related\w*|"
    r"repl(?:y|ies)|respond|responses?|search\w*|share\w*|sharing|sidebar\w*|side|signup|skip|social\w*|sponsor\w*|subscribe\w*|"
    r"teaser\w*|toolbar|topbar|widget\w*|alert\w*|complementary|contentinfo|navigation)(?:$|[^a-z])")
ARTICLE_HINTS = re.compile(r"(?:^|[^a-z])(?:article|articlebody|main|content|entry|post|story|maincontent)(?:$|[^a-z])")
# headings of an article, whatever else "header" may name
HEADING_HINTS = re.compile(r"(?:^|[^a-z])(?:article|entry|post|story|content)-+(?:header\w*|heading|title)(?=$|[^a-z])")
LONGEST_REPEAT = 24
LEAST_LEFT = 4  # boilerplate may not leave less than one part in so many of a page
VARIETY = 3  # pages that a text must be on, with at least twice as many texts in all as a page has, to be part of the template
LONGEST_TEXTS = 8  # of a page, that its content is known by
SALTS = 64  # groups in which the forms of a host are aligned first


def _hint(attribute: str, value: str) -> str:
    """What the pages of a template share of an attribute: no digits, and of an id only words that tell its kind."""
    if attribute == "id":
        value = " ".join(re.sub(r"^[^a-z]|[^a-z]$", "", m.group()) for kind in (HINTS, ARTICLE_HINTS) for m in kind.finditer(value))
    return re.sub(r"\d+", "-", value)


def elements(page: str) -> Iterator[tuple[str, str, str]]:
    """('open', name, hints), ('close', name, '') and ('text', text, '') in order; scripts and comments are left out."""
    at = 0
    for match in TOKEN.finditer(page):
        if match.start() > at:
            yield "text", page[at : match.start()], ""
        at = match.end()
        if match.group(3):
            name = match.group(3).lower()
            if match.group(2):
                yield "close", name, ""
            else:
                found = ATTRIBUTE.findall(match.group(4) or "")
                yield "open", name, " ".join(filter(None, (_hint(f[0].lower(), " ".join(f[1:]).strip().lower()) for f in found)))
        elif match.group(1):
            continue
    if at < len(page):
        yield "text", page[at:], ""


def read_page(page: str) -> tuple[list[str], list[tuple[list[tuple[str, int]], str, int]]]:
    """(token stream, blocks): a block is (elements around it with their places in the stream, text, characters of it in links)."""
    path: list[tuple[str, str, int]] = []
    stream: list[str] = []
    blocks: list[tuple[list[tuple[str, int]], str, int]] = []
    pieces: list[str] = []
    linked, links = 0, 0

    def flush() -> None:
        nonlocal linked
        text = " ".join(html_entities.unescape("".join(pieces)).split())
        if text:
            around = [(_plain(name + ("." + "-".join(hint.split()) if hint else "")), at) for name, hint, at in path if name not in INLINE]
            blocks.append(([*around, ("#", len(stream))], text, min(linked, len(text))))
            stream.append("#")
        pieces.clear()
        linked = 0

    for kind, name, hint in elements(page):
        if kind == "text":
            pieces.append(name)
            linked += len(name) if links else 0
        elif name == "br":
            pieces.append(" ")
        elif name in INLINE and not hint:
            links = max(0, links + (1 if kind == "open" else -1)) if name == "a" else links
        elif name in VOID:
            if name == "hr":
                flush()
        elif kind == "open":
            flush()
            if name in SECTIONS:
                for i in range(len(path) - 1, -1, -1):
                    if path[i][0] == name or (name[0] == "h" and path[i][0] == "p"):
                        del path[i:]
                        break
                    if path[i][0] in CONTAINERS:
                        break
            elif name in CONTAINERS and path and path[-1][0] == "p":
                path.pop()
            path.append((name, hint, len(stream)))
            stream.append("<" + _plain(name + ("." + "-".join(hint.split()) if hint else "")))
        else:
            open_names = [n for n, _, _ in path]
            if name in open_names:
                flush()
                at = len(open_names) - 1 - open_names[::-1].index(name)
                del path[at:]
                stream.append("/" + _plain(name))
    flush()
    return stream, blocks


Form = tuple  # of items: (text, optional, repeated) where text is a token or a folded form


def fold(stream: list[str]) -> Form:
    """The stream with tandem repeats folded into repeated groups, shortest first."""
    return fold_sizes(stream)[0]


def fold_sizes(stream: list[str]) -> tuple[Form, list[int]]:
    """The folded stream, and how many tokens of the stream each of its items covers."""
    items: list[tuple] = [(t, False, False) for t in stream]
    sizes = [1] * len(items)
    changed = True
    while changed:
        changed = False
        for width in range(1, min(LONGEST_REPEAT, len(items) // 2) + 1):
            out: list[tuple] = []
            covered: list[int] = []
            i = 0
            while i < len(items):
                unit = items[i : i + width]
                j = i + width
                while len(unit) == width and items[j : j + width] == unit:
                    j += width
                if j > i + width:
                    out.append((unit[0][0] if width == 1 else tuple(unit), False, True))
                    covered.append(sum(sizes[i:j]))
                    i, changed = j, True
                else:
                    out.append(items[i])
                    covered.append(sizes[i])
                    i += 1
            items, sizes = out, covered
    return tuple(items), sizes


def align(a: Form, b: Form) -> Form:
    """The least form of this kind that covers both: shared items in order, the others optional."""
    if a == b:
        return a
    names_a, names_b = [_unit(x) for x in a], [_unit(x) for x in b]
    rows = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a) - 1, -1, -1):
        for j in range(len(b) - 1, -1, -1):
            rows[i][j] = rows[i + 1][j + 1] + 1 if names_a[i] == names_b[j] else max(rows[i + 1][j], rows[i][j + 1])
    out: list[tuple] = []
    i = j = 0
    while i < len(a) or j < len(b):
        if i < len(a) and j < len(b) and names_a[i] == names_b[j]:
            out.append((a[i][0], a[i][1] or b[j][1], a[i][2] or b[j][2]))
            i, j = i + 1, j + 1
        elif j == len(b) or (i < len(a) and rows[i + 1][j] >= rows[i][j + 1]):
            out.append((a[i][0], True, a[i][2]))
            i += 1
        else:
            out.append((b[j][0], True, b[j][2]))
            j += 1
    # neighbours of one name are one repeated item
    merged: list[tuple] = []
    for item in out:
        if merged and _unit(merged[-1]) == _unit(item):
            merged[-1] = (item[0], merged[-1][1] and item[1], True)
        else:
            merged.append(item)
    return tuple(merged)


def _unit(item: tuple) -> str:
    """An item without its marks, so that one and many of it match."""
    return item[0] if isinstance(item[0], str) else "(" + " ".join(map(_unit, item[0])) + ")"


def write_form(form: Form) -> str:
    """The form as a regular expression over tokens: ``?`` optional, ``+`` repeated, ``*`` both."""
    marks = {(False, False): "", (True, False): "?", (False, True): "+", (True, True): "*"}
    return " ".join((i[0] if isinstance(i[0], str) else "(" + write_form(i[0]) + ")") + marks[i[1:]] for i in form)


def read_form(text: str) -> Form:
    """The form that ``write_form`` wrote."""
    stack: list[list] = [[]]
    for token in re.findall(r"\(|\)[?+*]?|[^\s()]+", text):
        if token == "(":
            stack.append([])
            continue
        mark = token[-1] if token[-1] in "?+*" else ""
        body = tuple(stack.pop()) if token[0] == ")" else token[: len(token) - len(mark)]
        stack[-1].append((body, mark in ("?", "*") and bool(mark), mark in ("+", "*") and bool(mark)))
    return tuple(stack[0])


def match(form: Form, wrapper: Form) -> list[int]:
    """The item of the wrapper that each item of the form is matched with, in order; -1 for none.

    As many items as can be are matched, then as few of the wrapper's required items as can be are passed over.
    """
    own, names = [_unit(x) for x in form], [_unit(x) for x in wrapper]
    n, m = len(own), len(names)
    passed = [0 if x[1] else 1 for x in wrapper]
    more = 1 + m  # what an unmatched item costs, above all required items together
    cost = [[0] * (m + 1) for _ in range(n + 1)]
    for j in range(m - 1, -1, -1):
        cost[n][j] = cost[n][j + 1] + passed[j]
    for i in range(n - 1, -1, -1):
        row, below, name = cost[i], cost[i + 1], own[i]
        row[m] = below[m] + more
        for j in range(m - 1, -1, -1):
            least = row[j + 1] + passed[j]
            if below[j] + more < least:
                least = below[j] + more
            if name == names[j]:
                # several neighbours of one name are one repeated item
                k = below[j + 1] if not wrapper[j][2] else min(below[j + 1], below[j] - passed[j])
                least = min(least, k)
            row[j] = least
    found, i, j = [], 0, 0
    while i < n:
        if j < m and own[i] == names[j] and wrapper[j][2] and cost[i][j] == cost[i + 1][j] - passed[j]:
            found.append(j)
            i += 1
        elif j < m and own[i] == names[j] and cost[i][j] == cost[i + 1][j + 1]:
            found.append(j)
            i, j = i + 1, j + 1
        elif j < m and cost[i][j] == cost[i][j + 1] + passed[j]:
            j += 1
        else:
            found.append(-1)
            i += 1
    return found


def host(url: str) -> Column:
    """The host of an address, '' where there is none."""
    return F.lower(F.coalesce(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^[A-Za-z][\w+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1), F.lit("")))


def _plain(token: str) -> str:
    """The token without the characters that forms and slots are written with."""
    return re.sub(r"[\s()?+*/@^$]", "_", token)


def parse(df: DataFrame, url: str, html: str, keep: tuple[str, ...]) -> DataFrame:
    """``keep``, ``__own`` (the host), ``__form`` and the texts of every page: ``__slots`` with the items of its form, ``__texts``, ``__links``."""
    source = df.select(*keep, host(url).alias("__own"), F.coalesce(F.col(html), F.lit("")).alias("__html"))
    kinds = {"__form": pa.string(), "__slots": pa.list_(pa.string()), "__texts": pa.list_(pa.string()), "__links": pa.list_(pa.int64())}
    schema = source.drop("__html").schema.add("__form", "string")
    for column, kind in (("__slots", StringType()), ("__texts", StringType()), ("__links", LongType())):
        schema = schema.add(column, ArrayType(kind))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "__html"):
            rows = []
            for page in batch["__html"].to_pylist():
                stream, blocks = read_page(page)
                form, sizes = fold_sizes(stream)
                item = [i for i, size in enumerate(sizes) for _ in range(size)]
                slots = ["/".join(f"{name}@{item[at]}" for name, at in around) for around, _, _ in blocks]
                rows.append((write_form(form), slots, [b[1] for b in blocks], [b[2] for b in blocks]))
            made = [pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds.values())]
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in (*keep, "__own")), *made], [*keep, "__own", *kinds])

    return materialize(source.mapInArrow(run, schema), "pages")


def _align_all(parsed: DataFrame) -> DataFrame:
    """``host`` and ``wrapper`` of every host: its distinct forms aligned in order, in ``SALTS`` groups first."""

    def combine(group: pd.DataFrame) -> pd.DataFrame:
        forms = sorted(set(group["wrapper"]))
        whole = read_form(forms[0])
        for form in forms[1:]:
            whole = align(whole, read_form(form))
        return pd.DataFrame({"host": [group["host"].iloc[0]], "wrapper": [write_form(whole)]})

    forms = parsed.select(F.col("__own").alias("host"), F.col("__form").alias("wrapper")).distinct()
    some = forms.groupBy("host", F.pmod(F.xxhash64("wrapper"), F.lit(SALTS)).alias("salt")).applyInPandas(
        lambda group: combine(group), "host string, wrapper string")
    return some.groupBy("host").applyInPandas(combine, "host string, wrapper string")


class Matcher:
    """Puts the texts of pages into the slots of their host's wrapper."""

    def __init__(self):
        self.wrappers: dict[str, Form] = {}
        self.matches: dict[tuple[str, str], list[int]] = {}

    def slots(self, name: str, wrapper: str, form: str, slots: list[str]) -> list[str]:
        """The slot of each text, marked ``^`` or ``$`` for the first and the last of a page in it."""
        if (name, form) not in self.matches:
            if len(self.matches) > 10_000:
                self.matches.clear()
                self.wrappers.clear()
            if name not in self.wrappers:
                self.wrappers[name] = read_form(wrapper)
            self.matches[name, form] = match(read_form(form), self.wrappers[name])
        items = self.matches[name, form]
        found = []
        for slot in slots:
            parts = [part.rpartition("@") for part in slot.split("/")]
            found.append("/".join(f"{label}@{items[int(i)]}" for label, _, i in parts))
        last = {slot: i for i, slot in enumerate(found)}
        seen: set[str] = set()
        marked = []
        for i, slot in enumerate(found):
            marked.append(slot + ("" if slot in seen else "^") + ("$" if slot in seen and last[slot] == i else ""))
            seen.add(slot)
        return marked


def _digest(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode()) >> 1


def _count_slots(matched: DataFrame) -> DataFrame:
    """``host``, ``slot``, ``pages``, ``chars``, ``link_chars``, ``digest`` and ``constant`` of every slot that is not below boilerplate."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher, slots = Matcher(), {}

        def emit() -> pa.RecordBatch:
            rows = [(h, s, *v[:6], sorted(v[6])) for (h, s), v in sorted(slots.items())]
            kinds = (pa.string(), pa.string(), *[pa.int64()] * 6, pa.list_(pa.int64()))
            names = ["host", "slot", "pages", "chars", "link_chars", "low", "high", "most", "mains"]
            slots.clear()
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)], names)

        for batch in batches:
            for name, wrapper, form, places, texts, links in zip(*(batch[c].to_pylist() for c in ("__own", "wrapper", "__form", "__slots", "__texts", "__links"))):
                main = {_digest(t) for t in sorted(texts, key=len, reverse=True)[:LONGEST_TEXTS]}
                marked = matcher.slots(name, wrapper, form, places)
                for slot, text, linked, out in zip(marked, texts, links, below_boilerplate(marked, texts, links)):
                    if out:
                        continue
                    digest = _digest(text)
                    seen = slots.setdefault((name, slot), [0, 0, 0, digest, digest, 0, set()])
                    seen[0] += 1
                    seen[1] += len(text)
                    seen[2] += linked
                    seen[3], seen[4] = min(seen[3], digest), max(seen[4], digest)
                    seen[5] = max(seen[5], len(main))
                    if len(seen[6]) < 3 * LONGEST_TEXTS:
                        seen[6] |= main
            if len(slots) > 20_000:
                yield emit()
        yield emit()

    found = matched.select("__own", "wrapper", "__form", "__slots", "__texts", "__links").mapInArrow(
        scan, "host string, slot string, pages long, chars long, link_chars long, low long, high long, most long, mains array<long>")
    contents = F.size(F.array_distinct(F.flatten(F.collect_list("mains"))))
    return found.groupBy("host", "slot").agg(
        F.sum("pages").alias("pages"), F.sum("chars").alias("chars"), F.sum("link_chars").alias("link_chars"), F.min("low").alias("digest"),
        ((F.min("low") == F.max("high")) & (F.sum("pages") >= VARIETY) & (contents >= 2 * F.max("most"))).alias("constant"))


def _matched(parsed: DataFrame) -> DataFrame:
    """The parsed pages, each with its host's wrapper."""
    wrappers = materialize(_align_all(parsed), "wrappers")
    return parsed.join(wrappers, F.col("__own") == F.col("host"), "left").drop("host")


def infer_wrappers(df: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """``host``, ``wrapper`` and ``slots`` (slot, pages, chars, link_chars, constant) of every host."""
    matched = _matched(parse(df, url, html, ()))
    slots = _count_slots(matched).groupBy("host").agg(
        F.sort_array(F.collect_list(F.struct("slot", "pages", "chars", "link_chars", "constant"))).alias("slots"))
    return matched.select(F.col("__own").alias("host"), "wrapper").distinct().join(slots, "host", "left")


def _labels(slot: str) -> list[tuple[str, str]]:
    """(element, hints) around a slot."""
    return [part.rpartition("@")[0].partition(".")[::2] for part in slot.split("/")[:-1]]


@functools.lru_cache(100_000)
def _marks(slot: str) -> tuple[bool, tuple[str, ...]]:
    """(whether the slot is below boilerplate in any case, elements around it that are boilerplate unless they hold the page)."""
    inside, doubtful = False, []
    parts = slot.split("/")
    for i, (name, hint) in enumerate(_labels(slot)):
        if name in ("html", "body"):
            continue
        hint = HEADING_HINTS.sub(" ", hint)
        if (name in BOILERPLATE and name != "form") or (name == "header" and not inside) or FIXED_HINTS.search(hint):
            return True, ()
        if name == "form" or HINTS.search(hint):
            doubtful.append("/".join(parts[: i + 1]))
        inside = inside or name in ("article", "main")
    return False, tuple(doubtful)


def below_boilerplate(slots: list[str], texts: list[str], links: list[int]) -> list[bool]:
    """Whether each text of a page is below boilerplate.

    Where the words of layout would leave less than ``1 / LEAST_LEFT`` of a page's text outside links, they
    don't count for an element that holds at least half of it: a form around the page, a column named for
    the sidebar beside it.
    """
    marks = [_marks(slot) for slot in slots]
    sizes = [len(text) - linked for text, linked in zip(texts, links)]
    left = sum(size for size, (fixed, doubtful) in zip(sizes, marks) if not fixed and not doubtful)
    total = sum(size for size, (fixed, _) in zip(sizes, marks) if not fixed)
    lifted: set[str] = set()
    if LEAST_LEFT * left < total:
        held: dict[str, int] = {}
        for size, (fixed, doubtful) in zip(sizes, marks):
            for element in () if fixed else doubtful:
                held[element] = held.get(element, 0) + size
        lifted = {element for element, size in held.items() if 2 * size >= total}
    return [fixed or any(element not in lifted for element in doubtful) for fixed, doubtful in marks]


class Evidence(NamedTuple):
    """What a host's slots tell of its pages."""

    links: set[str]  # slots that are mostly links
    constant: set[tuple[str, str]]  # (slot, digest of the text) of the template
    containers: list[str]  # elements, those with most text first


def read_evidence(dropped: list[str] | None, containers: list[str] | None) -> Evidence:
    pairs = [d.split("\t") for d in dropped or []]
    return Evidence({s for s, d in pairs if not d}, {(s.rstrip("^$"), d) for s, d in pairs if d}, containers or [])


def article(blocks: list[tuple[str, str, int]], evidence: Evidence) -> list[str]:
    """The texts of a page's article; a block is (slot, text, characters of it in links)."""
    out = below_boilerplate([b[0] for b in blocks], [b[1] for b in blocks], [b[2] for b in blocks])
    clean = [b for b, below in zip(blocks, out) if not below]
    free = [
        b for b in clean
        if b[0] not in evidence.links and sum(name == "article" for name, _ in _labels(b[0])) < 2
        and (b[0].rstrip("^$"), str(_digest(b[1]))) not in evidence.constant]
    for some in (free, clean):  # a page of nothing else is its own article
        named = [b for b in some if any(name in ("article", "main") for name, _ in _labels(b[0]))]
        if named:
            return [b[1] for b in named]
    some = free or clean
    volume: dict[str, int] = {}
    for slot, text, linked in some:
        above = "/".join(slot.split("/")[:-2])
        volume[above] = volume.get(above, 0) + len(text) - linked
    largest = max(volume.values(), default=0)
    if not largest:  # nothing but links
        return []
    hinted = [b for b in some if any(ARTICLE_HINTS.search(hint) for _, hint in _labels(b[0]))]
    if 2 * sum(len(text) - linked for _, text, linked in hinted) >= largest:
        return [b[1] for b in hinted]
    # the host's largest element that holds a good part of this page, or else this page's own largest
    best = next((c for c in evidence.containers if 2 * volume.get(c, 0) >= largest), None)
    if best is None:
        best = max(sorted(volume), key=lambda c: volume[c])
    return [b[1] for b in some if not best or b[0].startswith(best + "/")]


def extract(df: DataFrame, url: str = "url", html: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """``keep`` and ``text``, the article of every page: its blocks in order, one to a line."""
    matched = _matched(parse(df, url, html, keep))
    slots = materialize(_count_slots(matched), "slots")
    links = 2 * F.col("link_chars") > F.col("chars")
    dropped = slots.where(links | F.col("constant")).groupBy("host").agg(
        F.sort_array(F.collect_list(F.concat("slot", F.lit("\t"), F.when(links, "").otherwise(F.col("digest").cast("string"))))).alias("__dropped"))
    above = F.array_join(F.slice(F.split("slot", "/"), 1, F.greatest(F.size(F.split("slot", "/")) - 2, F.lit(0))), "/")
    volume = slots.where(~links & ~F.col("constant")).groupBy("host", above.alias("above")).agg(F.sum(F.col("chars") - F.col("link_chars")).alias("n"))
    ranked = volume.groupBy("host").agg(F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("n"), "above")))["above"].alias("__containers"))
    evidence = materialize(dropped.join(ranked, "host", "full"), "evidence").withColumnRenamed("host", "__host")
    rows = matched.join(evidence, F.col("__own") == F.col("__host"), "left").drop("__host")
    schema = df.select(*keep).schema.add("text", "string")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher, known = Matcher(), {}
        for batch in batches:
            texts = []
            for name, wrapper, form, places, found, links, dropped, containers in zip(
                    *(batch[c].to_pylist() for c in ("__own", "wrapper", "__form", "__slots", "__texts", "__links")), batch["__dropped"], batch["__containers"]):
                if name not in known:
                    if len(known) > 10_000:
                        known.clear()
                    known[name] = read_evidence(dropped.as_py(), containers.as_py())
                texts.append("\n".join(article(list(zip(matcher.slots(name, wrapper, form, places), found, links)), known[name])))
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in keep), pa.array(texts, pa.string())], [*keep, "text"])

    return rows.mapInArrow(run, schema)


def op3_html_extract(spark, sf_dir: str) -> DataFrame:
    """The article of every row of ``pages``."""
    found = extract(spark.read.parquet(table_path(sf_dir, "pages")))
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


QUERIES = {"op3_html_extract": (op3_html_extract, None)}
