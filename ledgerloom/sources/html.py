"""HTML trees and what is read from them (H1, H2, H5–H7, H9, H11, F22): Arrow-batched table functions.

Pages that cannot hold anything are dropped by native filters before Python.
The tree is error-tolerant: void elements, implied ends of p, li, tr, td, th,
option, dt and dd, and unmatched end tags are handled.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Callable, Iterator, Sequence
from functools import lru_cache
from html.parser import HTMLParser
from urllib.parse import unquote, urljoin, urlsplit

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .. import policy as P
from .session import ship

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
CLOSES = {"p": {"p"}, "li": {"li"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}}
BLOCKS = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split())
SCOPES = frozenset("table ul ol dl select div article section body td th".split())


class Node:
    """An element (tag, attrs, children) or, with tag None, a text."""

    __slots__ = ("tag", "attrs", "children", "parent", "data")

    def __init__(self, tag, attrs=None, parent=None, data=""):
        self.tag, self.attrs, self.children, self.parent, self.data = tag, attrs or {}, [], parent, data

    def walk(self) -> Iterator[Node]:
        stack = [self]
        while stack:
            n = stack.pop()
            yield n
            stack.extend(reversed(n.children))

    def elements(self, *tags: str) -> Iterator[Node]:
        """Descendants with one of the tags (any, if none is given)."""
        stack = self.children[::-1]
        while stack:
            n = stack.pop()
            if n.tag is not None:
                if not tags or n.tag in tags:
                    yield n
                stack += n.children[::-1]

    def text(self, sep: str = "") -> str:
        out, stack = [], [self]
        while stack:
            n = stack.pop()
            if n.tag is None:
                out.append(n.data)
            else:
                stack += n.children[::-1]
        return sep.join(out)

    def drop(self) -> None:
        if self.parent:
            self.parent.children.remove(self)


# tags without attributes that change nothing in how the parser reads on
_BARE = "a|article|b|body|button|dd|details|div|dl|dt|em|footer|h[1-6]|head|header|html|i|li|main|nav|ol|p|section|small|span|strong|summary|table|tbody|td|th|thead|tr|u|ul"
_OPEN, _CLOSE = re.compile(f"<({_BARE})>"), re.compile(f"</({_BARE})>")


class _Builder(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = self.at = Node("#root")

    def updatepos(self, i, j):
        return j  # lines are not counted

    def parse_starttag(self, i):
        m = _OPEN.match(self.rawdata, i)
        if not m:
            return super().parse_starttag(i)
        self.handle_starttag(m[1], ())
        return m.end()

    def parse_endtag(self, i):
        m = _CLOSE.match(self.rawdata, i) if self.cdata_elem is None else None
        if not m:
            return super().parse_endtag(i)
        self.handle_endtag(m[1])
        return m.end()

    def handle_starttag(self, tag, attrs):
        ends = CLOSES.get(tag, {"p"} if tag in BLOCKS else set())
        n = self.at
        while n.parent and n.tag not in SCOPES - ends:
            if n.tag in ends:
                self.at = n.parent
            n = n.parent
        node = Node(tag, {k: v or "" for k, v in attrs}, self.at)
        self.at.children.append(node)
        if tag not in VOID:
            self.at = node

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        n = self.at
        while n.parent and n.tag != tag:
            n = n.parent
        if n.parent:
            self.at = n.parent

    def handle_data(self, data):
        if self.at.children and self.at.children[-1].tag is None:
            self.at.children[-1].data += data
        else:
            self.at.children.append(Node(None, parent=self.at, data=data))


def parse(html: str | None) -> Node:
    b = _Builder()
    b.feed(html or "")
    b.close()
    return b.root


def body_of(root: Node) -> Node:
    return next(root.elements("body"), root)


def squeeze(s: str) -> str:
    return " ".join(s.split())


@lru_cache(1 << 14)
def _folded(s: str) -> str:
    return fold_long(s)


def fold(s: str) -> str:
    """P14 in Python; short texts are remembered."""
    return s.lower() if s.isascii() else _folded(s) if len(s) <= 64 else fold_long(s)


def fold_long(s: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFD", s) if not unicodedata.combining(c)).lower()


# --- addresses and names in Python, for the trees -----------------------------

_MAIL = re.compile(P.CLASSIC_EMAIL, re.I | re.A)
_HIDDEN_MAIL = re.compile(P.CLASSIC_HIDDEN, re.I | re.A)
_UPPER, _ANY = P.UPPER, "A-Za-z" + P.UPPER[3:] + P.LOWER[3:]
_HINT = re.compile(rf"(?:(?<=[A-Za-z0-9_])(?![A-Za-z0-9_])|(?<![A-Za-z0-9_])(?=[A-Za-z0-9_]))[{_UPPER}][{_ANY}-]+\s+[{_UPPER}][{_ANY}-]+(?:(?<=[A-Za-z0-9_])(?![A-Za-z0-9_])|(?<![A-Za-z0-9_])(?=[A-Za-z0-9_]))")
_WORD = rf"[{_UPPER}][{_ANY}]+(?:-[{_UPPER}][{_ANY}]+)?"
_NAME = re.compile(rf"(?:^|[\s,;:()|])((?:(?:{P.TITLES})\.?\s+)*({_WORD})\s+({_WORD}))(?:$|[\s,;:()|])")
_TITLED = re.compile(rf"(?<![A-Za-z0-9_])(?:{P.TITLES})\.", re.I)
_FRONT = re.compile(rf"^(?:(?:{P.TITLES})\.?\s+)+", re.I)
_PLAIN = re.compile(r"^[^\s@]+@[^\s@]+\.[^\s@]+$")
_BATCH_MAIL = re.compile(P.BATCH_EMAIL, re.I | re.A)
_RUN = regex.compile(r"(?<!\p{L})(?:\p{Lu}[\p{L}'’-]+\s+){1,3}\p{Lu}[\p{L}'’-]+")
_ROLES = re.compile(P.BATCH_ROLES, re.I)
_AT, _DOT = re.compile(P.BATCH_AT, re.I), re.compile(P.BATCH_DOT, re.I)
_BEFORE = re.compile(rf"^(?:(?:{P.TITLES_BEFORE})(?:\.\s*|\s+))+", re.I)
_AFTER = re.compile(rf"(?:,?\s+(?:{P.TITLES_AFTER}))+$|\s*\([^)]*\)\s*$", re.I)
_ODD, _LABEL = re.compile(r"[^\x21-\x7e]|[<>\"',;:]"), re.compile(r"[a-z0-9]([a-z0-9-]*[a-z0-9])?", re.I)
_LINES, _BLANKS, _GAPS = re.compile(r"[\n\r;|]+"), re.compile(r"[ \t]+"), re.compile(r"\n\s*\n")
_FOLDS = re.compile("[\u0130\u0131\u017f\u212a]")  # letters that match ASCII ones with case ignored, or change their length
_JOINED = re.compile(f"([{P.LOWER}])([{_UPPER}])")
_SERVICE = re.compile(P.SERVICE_WORDS, re.I)
_CLASSIC_ROLES = [(re.compile(p, re.I), role) for p, role in P.CLASSIC_ROLES]


@lru_cache(1 << 12)
def _valid(mail: str) -> bool:
    local, at, host = mail.partition("@")
    if not at or "@" in host or _ODD.search(mail):
        return False
    if not 0 < len(local) <= 64 or local[0] == "." or local[-1] == "." or ".." in local or "." not in host:
        return False
    return all(_LABEL.fullmatch(x) for x in host.split("."))


def batch_valid(mail: str) -> bool:
    """P3 in Python."""
    return len(mail) <= 254 and _valid(mail)


def mails_in(text: str) -> list[str]:
    """P12 in Python."""
    t = _DOT.sub(".", _AT.sub("@", text)) if "[" in text or "(" in text else text
    if "@" not in t:
        return []
    return list(dict.fromkeys(m for m in (x.strip(".").lower() for x in _BATCH_MAIL.findall(t)) if batch_valid(m)))


def split_name(value: str, given: frozenset[str]) -> tuple[str, str, str] | None:
    """P19 in Python: (first, last, published). Short ones are remembered: a page's entries are read block by block, outwards."""
    s = squeeze(value)
    return _short_name(s, given) if len(s) <= 100 else _split_name(s, given)


@lru_cache(1 << 13)
def _short_name(published: str, given: frozenset[str]) -> tuple[str, str, str] | None:
    return _split_name(published, given)


def _split_name(published: str, given: frozenset[str]) -> tuple[str, str, str] | None:
    if " " not in published:
        return None
    words = _AFTER.sub("", _BEFORE.sub("", published)).split()
    proper = lambda w: len(w) > 1 and w[0].isalpha() and all(c.isalpha() or unicodedata.category(c)[0] == "M" or c in "'’.-" for c in w)
    if not 2 <= len(words) <= 5 or not all(map(proper, words)):
        return None
    known = [fold(w) in given for w in words]
    if known[0]:
        n = next((k for k, g in enumerate(known[:-1]) if not g), len(words) - 1)
        first, last = words[:n], words[n:]
    elif known[-1] and len(words) <= 3:
        first, last = words[-1:], words[:-1]
    else:
        return None
    if any(not w[0].isupper() or fold(w) in P.NO_SURNAME for w in last):
        return None
    return " ".join(first), " ".join(last), published


def names_in(text: str, given: frozenset[str]) -> dict[str, tuple[str, str, str]]:
    """H8 in Python: names by folded key."""
    out = {}
    for line in _LINES.split(text):
        whole = split_name(line, given)
        runs = [line] if whole else _RUN.findall(line)
        for r in runs:
            if p := split_name(r, given):
                out[fold(f"{p[0]}|{p[1]}")] = p
    return out


# --- H1, H2 -------------------------------------------------------------------


def context_of(node: Node | None) -> str:
    """The nearest text of the node or its 8 ancestors, up to 1200 characters, that hints at a person; else the last that fits."""
    fallback = ""
    for _ in range(P.CONTEXT_LEVELS + 1):
        if node is None or node.tag == "#root":
            break
        t = squeeze(node.text())
        if 0 < len(t) <= P.CONTEXT_CHARS:
            fallback = t
            if _HINT.search(t):
                return t
        node = node.parent
    return fallback


def email_occurrences(html: str, url: str) -> list[tuple[str, str, str, str]]:
    """(email, context, url, kind) of mail links and of texts below the body's elements."""
    root = parse(html)
    for n in list(root.elements("script", "style", "noscript", "template")):
        n.drop()
    found: dict[tuple[str, str], tuple[str, str, str, str]] = {}

    def add(mail: str, node: Node, kind: str) -> None:
        mail = mail.strip().lower()
        if _PLAIN.match(mail):
            context = context_of(node)
            key = (mail, context.lower())
            if key not in found or (kind == "MAILTO" and found[key][3] != "MAILTO"):
                found[key] = (mail, context, url, kind)

    for a in root.elements("a"):
        href = a.attrs.get("href", "")
        if href[:7].lower() == "mailto:":
            raw = href[7:].split("?")[0]
            try:
                mail = unquote(raw, errors="strict").strip()
            except UnicodeDecodeError:
                mail = raw.strip()
            add(mail, a, "MAILTO")
    for n in body_of(root).elements():
        for t in n.children:
            if t.tag is None:
                if "@" in t.data:
                    for m in _MAIL.finditer(t.data):
                        add(m.group(), n, "TEXT")
                low = t.data.lower()
                if "at]" in low or "at)" in low or "zavinac" in low:
                    for m in _HIDDEN_MAIL.finditer(t.data):
                        add(f"{m[1]}@{m[2]}.{m[3]}", n, "OBFUSCATED")
    return list(found.values())


def comparable(s: str) -> str:
    return re.sub(r"[^a-z0-9]+", " ", fold(s)).strip()


def names_before(context: str, mail: str, school: str | None) -> list[tuple[str, str]]:
    """Names before the e-mail, their start at most 160 characters (without titles) away."""
    t, out = _JOINED.sub(r"\1 \2", context), {}
    if mail.isascii() and not _FOLDS.search(t):
        at = t.lower().find(mail.lower())
        prefix = t[:at] + " "
    else:
        t = re.sub(re.escape(mail), lambda m: f" {mail} ", t, count=1, flags=re.I)
        at = t.lower().find(mail.lower())
        prefix = t[:at]
    if at < 0:
        return []
    whole = comparable(school) if school else ""
    for m in _NAME.finditer(prefix):
        first, last = m[2], m[3]
        if first in P.NO_PERSON or last in P.NO_PERSON:
            continue
        raw = _FRONT.sub("", m[1]).strip()
        if whole and comparable(raw) and comparable(raw) in whole:
            continue
        out[comparable(f"{first} {last}")] = (first, last, m.start(), raw)
    return [(f, n) for f, n, start, raw in sorted(out.values(), key=lambda x: x[2]) if len(prefix) - (start + len(raw)) <= P.NAME_REACH]


def pair(mail: str, context: str, kind: str, school: str | None) -> tuple[str, str | None, str | None, str | None, float | None]:
    """(outcome, first, last, role, confidence) of an occurrence."""
    if "@" in context and len({m.lower() for m in _MAIL.findall(context)}) > 1:
        return "AMBIGUOUS", None, None, None, None
    people = names_before(context, mail, school)
    if len(people) != 1:
        return ("AMBIGUOUS" if people else "UNPAIRED"), None, None, None, None
    role = next((r for p, r in _CLASSIC_ROLES if p.search(context)), None)
    points = 80 + 8 * (kind == "MAILTO") + 6 * (role is not None) + 4 * bool(_TITLED.search(context))
    return "VERIFIED", *people[0], role, min(points, 98) / 100


# --- H5, H6, H7 -----------------------------------------------------------------


def profile_names(html: str) -> list[str]:
    """H5: distinct headings in buttons that open a profile."""
    out = {}
    for b in parse(html).elements("button"):
        if re.search("zobrazit profil", b.text(), re.I) and (h := next(b.elements("h3", "h4"), None)) and (n := squeeze(h.text())):
            out[n] = None
    return list(out)


def portal_website(html: str, url: str, ident: str) -> str | None:
    """The first link off the portal in a row that says 'Web:', of a valid record of the identifier."""
    body = body_of(parse(html))
    shown = body.text()
    if not ident or ident not in shown or P.INVALID_RECORD in shown:
        return None
    bare = lambda u: re.sub("^www[.]", "", (urlsplit(u).hostname or ""))
    for row in body.elements("tr"):
        if "Web:" in row.text() and len(squeeze(row.text())) < 2500:
            for a in row.elements("a"):
                u = urljoin(url, a.attrs.get("href", ""))
                if urlsplit(u).scheme in ("http", "https") and bare(u) != bare(url):
                    return u
    return None


def readable(node: Node) -> str:
    """H9."""
    return _GAPS.sub("\n", _BLANKS.sub(" ", node.text("\n"))).strip()


_HIDE = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_UNSEEN = frozenset("script style noscript template iframe".split())
_HEADS = ("h2", "h3", "h4", "h5")
_ENDS = frozenset("html body footer nav #root".split())  # blocks that say nothing of one person


def visible(html: str | None) -> Node:
    """The tree without what a reader does not see."""
    root = parse(html)
    for n in list(root.elements()):
        a = n.attrs
        if n.tag in _UNSEEN or a and ("hidden" in a or a.get("aria-hidden") == "true" or _HIDE.search(a.get("style", ""))):
            n.drop()
    return root


def mail_link(node: Node) -> str | None:
    """The address part of a mail link, null of any other node."""
    href = node.attrs.get("href", "") if node.tag == "a" else ""
    return unquote(href[7:].split("?")[0]) if href[:7].lower() == "mailto:" else None


class Block:
    """An element around an address: its text, the addresses in it and the people it names."""

    def __init__(self, node: Node, text: str, given: frozenset[str]):
        self.text = text
        linked = [unquote(a.attrs["href"]) for a in node.elements("a") if mail_link(a) is not None]
        self.mails = {*mails_in(text), *(m for href in linked for m in mails_in(href))}
        self.titles = [h for h in node.elements() if h.tag in _HEADS or h.attrs.get("itemprop") == "name"]
        cells = [*node.elements("td", "th")] if node.tag == "tr" else []
        whole = [p for p in (split_name(squeeze(x.text()), given) for x in [*self.titles, *cells]) if p]
        self.people = {fold(f"{p[0]}|{p[1]}"): p for p in whole} | names_in(text, given)
        self.entry = bool(self.people or self.titles) or node.tag in ("tr", "li", "article")


def evidence_of(node: Node, mail: str, given: frozenset[str]) -> tuple[str, list]:
    """H7: (text, people) of the nearest block that tells whose the address is; ('', []) if there is none.

    Blocks are tried outwards. One with foreign addresses ends the search as
    evidence that names nobody, one that is an entry of a list or names people as
    evidence of these, a long or page-wide one without evidence.
    """
    at, steps = node, 0
    while at is not None and at.tag not in _ENDS and steps < P.CONTEXT_LEVELS:
        text = readable(at)
        if len(text) > P.BLOCK_CHARS:
            break
        block = Block(at, text, given)
        if block.mails - {mail}:
            return text, []
        if block.entry:
            return text, list(block.people.values())
        at, steps = at.parent, steps + 1
    return "", []


def objection(node: Node, mail: str, evidence: str, people: list) -> str | None:
    """why an address with evidence is not taken for a person's, null if it is."""
    shown, linked = mails_in(node.text()), mails_in(mail_link(node) or "")
    if shown and linked and shown[0] != linked[0]:
        return "LINK_TEXT_CONFLICT"
    if len(people) != 1 or set(mails_in(evidence)) - {mail}:
        return "AMBIGUOUS_BLOCK"
    if _SERVICE.search(evidence):
        return "EXTERNAL_SERVICE_CONTACT"
    return "GENERAL_MAILBOX" if mail.split("@")[0] in P.GENERIC["batch"] else None


def _addresses(root: Node) -> Iterator[tuple[Node, str, str]]:
    """(element, address, method) of mail links, then of texts."""
    for a in root.elements("a"):
        yield from ((a, m, "STATIC_MAILTO") for m in mails_in(mail_link(a) or ""))
    for n in body_of(root).elements():
        yield from ((n, m, "STATIC_TEXT") for t in n.children if t.tag is None for m in mails_in(t.data))


def page_contacts(html: str, url: str, given: frozenset[str]) -> list[tuple]:
    """H6, H7: rows (kind, email, first, last, role, reason, method, evidence_hash) of a page; kind CONTACT or REVIEW.

    An address without evidence is listed each time, one with evidence once for
    each evidence.
    """
    rows, seen = [], set()
    for node, mail, method in _addresses(visible(html)):
        evidence, people = evidence_of(node, mail, given)
        if not evidence:
            rows.append(("REVIEW", mail, None, None, None, "EMAIL_WITHOUT_PERSON", method, None))
            continue
        digest = hashlib.sha256(evidence.encode()).hexdigest()
        if (mail, digest) in seen:
            continue
        seen.add((mail, digest))
        if reason := objection(node, mail, evidence, people):
            rows.append(("REVIEW", mail, None, None, None, reason, method, digest))
        else:
            rows.append(("CONTACT", mail, *people[0][:2], "; ".join(dict.fromkeys(_ROLES.findall(evidence))), None, method, digest))
    return rows


_PROFILE, _CONTROL, _NEXT, _MISSING = (re.compile(x, re.I) for x in (P.PROFILE_WORDS, P.STAFF_CONTROLS, P.NEXT_WORDS, P.NOT_FOUND))


def page_outline(html: str, given: frozenset[str]) -> dict:
    """What a page shows besides contacts: title, h1, text, links, names, addresses, controls and flags."""
    root = visible(html)
    first = lambda tag: squeeze(next((n.text() for n in root.elements(tag)), ""))
    title, h1, text = squeeze(" ".join(n.text() for n in root.elements("title"))), first("h1"), readable(body_of(root))
    links = [{"href": a.attrs["href"], "label": squeeze(a.text()), "rel": a.attrs.get("rel", "")} for a in root.elements("a") if "href" in a.attrs]
    buttons = [n for n in root.elements() if n.tag == "button" or n.attrs.get("role") == "button"]
    closed = [n for n in root.elements() if (n.tag == "details" and "open" not in n.attrs) or n.attrs.get("aria-expanded") == "false"]
    cards, accordions = sum(bool(_PROFILE.search(b.text())) for b in buttons), sum(bool(_CONTROL.search(n.text())) for n in closed)
    usable = [x for x in links if not re.match("(?i)(?!https?:)[a-z][a-z0-9+.-]*:", x["href"].strip())]
    return {
        "title": title, "h1": h1, "text": text, "links": links, "mails": mails_in(text),
        "names": [{"first_name": f, "last_name": n, "published_name": p} for f, n, p in names_in(text, given).values()],
        "profile_cards": cards, "accordions": accordions, "interactive": cards > 0 or accordions > 0,
        "js_shell": len(text) < 500 and "<script" in html,
        "pagination": any(_NEXT.search(x["label"]) for x in usable) or any(x["rel"] == "next" for x in links),
        "soft404": bool(_MISSING.search(f"{title} {h1}")),
    }


OUTLINE = "title string, h1 string, text string, links array<struct<href:string,label:string,rel:string>>, mails array<string>, names array<struct<first_name:string,last_name:string,published_name:string>>, profile_cards int, accordions int, interactive boolean, js_shell boolean, pagination boolean, soft404 boolean"


# --- the table functions ------------------------------------------------------------


def may_hold_mail(html: Column) -> Column:
    """A native superset of the pages that can give an address."""
    return F.coalesce(F.lower(html).rlike("@|mailto:|&#|&commat;|at\\s*[\\])]|zavin"), F.lit(False))


def _table(df: DataFrame, html: str, url: str, extra: Sequence[str], schema: str, rows: Callable) -> DataFrame:
    ship(df.sparkSession)
    names = StructType.fromDDL(schema).names

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = [(u, *r) for h, u, *more in b.itertuples(index=False) for r in rows(h or "", u or "", *more)]
            yield pd.DataFrame(out, columns=names).astype(object)

    return df.select(html, url, *extra).mapInPandas(run, schema)


def occurrences(pages: DataFrame, html: str = "html", url: str = "url") -> DataFrame:
    """H1 of every page: url, email, context, kind. A null page has none."""
    return _table(pages.filter(may_hold_mail(F.col(html))), html, url, (), "url string, email string, context string, kind string", lambda h, u: [(m, c, k) for m, c, _, k in email_occurrences(h, u)])


def pairs(pages: DataFrame, html: str = "html", url: str = "url", school: str = "school_name") -> DataFrame:
    """H1 and H2 of every page: url, email, kind, outcome, first_name, last_name, role, confidence."""
    schema = "url string, email string, kind string, outcome string, first_name string, last_name string, role string, confidence double"
    return _table(pages.filter(may_hold_mail(F.col(html))), html, url, (school,), schema, lambda h, u, s: [(m, k, *pair(m, c, k, s)) for m, c, _, k in email_occurrences(h, u)])


def contacts(pages: DataFrame, html: str = "html", url: str = "url", given: Sequence[str] = P.GIVEN_NAMES) -> DataFrame:
    """H6 and H7 of every page."""
    known = frozenset(map(fold, given))
    schema = "url string, kind string, email string, first_name string, last_name string, role string, reason string, method string, evidence_hash string"
    return _table(pages.filter(may_hold_mail(F.col(html))), html, url, (), schema, lambda h, u: page_contacts(h, u, known))


def inventories(pages: DataFrame, html: str = "html", url: str = "url") -> DataFrame:
    """H5 of every page: url, pos, name. Markup and entities may split the label, so only the tags are looked for first."""
    return _table(pages.filter(F.lower(html).contains("<button") & F.lower(html).rlike("<h[34]")), html, url, (), "url string, pos int, name string", lambda h, u: list(enumerate(profile_names(h))))


def outlines(pages: DataFrame, html: str = "html", url: str = "url", given: Sequence[str] = P.GIVEN_NAMES) -> DataFrame:
    """H6 and F22 of every page: url and the columns of OUTLINE. A null page is an empty one."""
    known = frozenset(map(fold, given))
    keys = StructType.fromDDL(OUTLINE).names
    return _table(pages, html, url, (), f"url string, {OUTLINE}", lambda h, u: [tuple(o[k] for k in keys) for o in (page_outline(h, known),)])


def portal_websites(records: DataFrame, html: str = "html", url: str = "url", ident: str = "red_izo") -> DataFrame:
    """H11, S17 of captured portal records: url, red_izo, website; records without one give no row."""
    rows = records.filter(F.col(html).contains("Web:") & F.col(html).contains(F.col(ident)))
    return _table(rows, html, url, (ident,), "url string, red_izo string, website string", lambda h, u, i: [(i, w) for w in (portal_website(h, u, i),) if w])
