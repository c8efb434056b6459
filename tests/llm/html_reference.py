"""A second, slow form of the two-pass rules for well-formed pages: a tree, and searches over all blocks."""

from __future__ import annotations

import unicodedata
from html.parser import HTMLParser

from framelake.llm import html_extract as h

R = h.Rules()
DENSE = ("CJK", "HIRAGANA", "KATAKANA", "HANGUL", "THAI", "LAO", "MYANMAR", "KHMER")
SKIPPED = set(h.DROPPED.split("|"))


class Tree(HTMLParser):
    """Blocks as dicts; every element open is a tuple (tag, mark, number)."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open, self.out, self.text, self.link, self.n, self.skip, self.breaks, self.tag = [], [], "", 0, 0, 0, 0, ""

    def cut(self):
        text = " ".join(self.text.split())
        if text:
            blocks = [x for x in self.open if x[0] in h.BLOCK_TAGS]
            regions = [x[2] for x in blocks if x[1] == 2]
            self.out.append({"text": text, "links": self.link, "boiler": any(x[1] == 1 for x in blocks), "region": regions[0] if regions else 0, "tag": self.tag, "path": [x[2] for x in self.open if x[0] in h.CONTAINERS]})
        self.text, self.link, self.breaks = "", 0, 0

    def handle_starttag(self, tag, attrs):
        if tag in SKIPPED:
            self.skip += 1
            return
        if tag == "br":
            self.text, self.breaks = self.text + " ", self.breaks + 1
            if self.breaks > 1:
                self.cut()
            return
        if tag in h.BLOCK_TAGS:
            self.cut()
            self.tag = tag
            if tag not in ("li", "td", "tr"):
                top = len(self.open) - 1
                while top >= 0 and self.open[top][0] not in h.BLOCK_TAGS:
                    top -= 1
                if top >= 0 and self.open[top][0] == "p":
                    del self.open[top:]
        if tag in h.VOID_TAGS:
            return
        inside = any(x[1] == 2 for x in self.open)
        names = " ".join(f'{k}="{v}"' if v is not None else k for k, v in attrs)
        self.n += 1
        self.open.append((tag, h._marks(tag, " " + names if names else "", inside), self.n))

    def handle_startendtag(self, tag, attrs):
        if tag == "br":
            self.handle_starttag(tag, attrs)
        elif tag in h.BLOCK_TAGS:
            self.cut()

    def handle_endtag(self, tag):
        if tag in SKIPPED:
            self.skip -= 1
            return
        if tag in h.BLOCK_TAGS:
            self.cut()
            self.tag = ""
        at = [i for i, x in enumerate(self.open) if x[0] == tag]
        if at:
            del self.open[at[-1] :]

    def handle_data(self, data):
        if self.skip or any(x[1] == 1 and x[0] not in h.BLOCK_TAGS for x in self.open):
            return
        self.text += data
        if data.strip():
            self.breaks = 0
            if any(x[0] == "a" for x in self.open):
                self.link += len(data.strip())


def size(text):
    return sum(2 if any(unicodedata.name(c, "").startswith(s) for s in DENSE) else 1 for c in text)


def stops(text):
    words = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    return max((sum(w in s for w in words) / len(words) for s in map(set, h.STOP_WORDS.values())), default=0) if words else 0


def marks(text):
    return 100 * len([c for c in text if c in h.SENTENCE_MARKS]) / size(text)


def main_text(page):
    tree = Tree()
    tree.feed(page)
    tree.close()
    tree.cut()
    found = tree.out
    plain = [b for b in found if not b["boiler"] and size(b["text"]) >= R.short and b["links"] <= R.some_links * len(b["text"])]
    total = sum(size(b["text"]) for b in plain)
    fits = not total or sum(size(b["text"]) * stops(b["text"]) for b in plain) >= R.stop_low * total

    def level(text):
        d = stops(text)
        if not fits and marks(text) >= R.marks_per_hundred:
            d = max(d, R.stop_high)
        return (d >= R.stop_low) + (d >= R.stop_high)

    outside = [b for b in found if not b["region"] and not b["boiler"]]
    if outside and any(b["region"] and not b["boiler"] for b in found):
        some = [b for b in found if not b["boiler"] and b["links"] <= R.some_links * len(b["text"])]
        kinds = [[b for b in plain if level(b["text"]) == 2], [b for b in plain if level(b["text"])], some]
        used = next((k for k in kinds if k), [])
        prose = {r: sum(size(b["text"]) for b in used if b["region"] == r) for r in {b["region"] for b in found}}
        told = [r for r in prose if r and (prose[r] >= R.long or 2 * prose[r] >= sum(prose.values()))]
        most = 2 * sum(prose[r] for r in told) >= sum(prose.values())
        if used is some or not used:
            told = [r for r in prose if r and prose[r]]
            most = bool(told)
        for b in found:
            if b["region"] not in told:
                b["boiler"], b["region"] = b["boiler"] or most, b["region"] if most else 0

    for b in found:
        t, n, share = b["text"], size(b["text"]), b["links"] / len(b["text"])
        b["heading"] = b["tag"] in ("h1", "h2", "h3", "h4", "h5", "h6")
        if b["boiler"]:
            b["label"] = "bad"
        elif share > R.max_links:
            b["label"] = "links" if b["region"] else "bad"
        elif not b["region"] and "©" in t and n < R.long:
            b["label"] = "bad"
        elif n < R.short or share > R.some_links:
            b["label"] = "short"
        elif level(t) == 2:
            b["label"] = "good" if n >= R.long else "near"
        elif level(t) == 1:
            b["label"] = "near"
        else:
            b["label"] = "short" if b["region"] or t[-1] in h.SENTENCE_ENDS and marks(t) >= R.marks_per_hundred else "bad"

    def together(a, b):
        return len([1 for i in range(min(len(a["path"]), len(b["path"]))) if a["path"][: i + 1] == b["path"][: i + 1]])

    def second(group, article):
        def asked(b):
            return "links" if b["label"] == "links" else "heading" if b["heading"] else "rest"

        for turn in ("links", "rest", "heading"):
            if turn == "rest" and not article and all(b["label"] != "good" for b in group):
                kind = "near" if any(b["label"] == "near" for b in group) else "short"
                for b in group:
                    b["label"] = "good" if b["label"] == kind else b["label"]
            new = {}
            for i, b in enumerate(group):
                if b["label"] in ("good", "bad") or asked(b) != turn:
                    continue
                left = next((x for x in group[:i][::-1] if x["label"] in ("good", "bad")), None)
                right = next((x for x in group[i + 1 :] if x["label"] in ("good", "bad")), None)
                edge = None if not article else "bad" if turn == "links" and b["tag"] not in h.PARAGRAPHS else "good"
                if turn == "links" and not article:
                    edge = None
                sides = [left["label"] if left else edge, right["label"] if right else edge]
                if turn == "heading" and right:
                    new[i] = right["label"]
                elif None in sides or sides[0] == sides[1]:
                    new[i] = sides[0] or sides[1] or ("good" if b["label"] == "near" else "bad")
                elif left and right and together(b, left) != together(b, right):
                    new[i] = max((left, right), key=lambda x: together(b, x))["label"]
                else:
                    new[i] = "good" if b["label"] == "near" or article and turn != "links" else "bad"
            for i, label in new.items():
                group[i]["label"] = label

    for r in {b["region"] for b in found if b["region"]}:
        second([b for b in found if b["region"] == r and not b["boiler"]], True)
    second([b for b in found if not b["region"]], False)
    return "\n".join(b["text"] for b in found if b["label"] == "good")
