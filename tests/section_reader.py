"""Sections of a page read with Python's own parser: what the column functions are compared with."""

from html.parser import HTMLParser

VOID_TAGS = frozenset("area base br col embed hr img input link meta source track wbr".split())
IMAGE_TAG = "img"
SILENT_TAGS = frozenset(["script", "style", "template"])


class NothingLeft(Exception):
    """The last section is read; the rest of the page cannot add anything."""


class SectionReader(HTMLParser):
    """Collects, per section, the text of its ``text_tag`` elements and an attribute.

    A section is a ``tag`` element with one of ``classes`` (any element if there are
    none). ``sections`` holds, per section in page order, its classes, the text pieces of
    each text element, every value of ``attribute``, and that value for each image (None
    where the image lacks it).
    """

    def __init__(self, tag, classes, text_tag, attribute):
        super().__init__(convert_charrefs=True)
        self.tag, self.classes, self.text_tag = tag, frozenset(classes), text_tag
        self.attribute = attribute
        self.open = []  # (tag, section or None, text pieces or None)
        self.sections = []
        self.left = 0  # mentions in the page that may still start a section

    def read(self, html):
        words = self.classes or [f"<{self.tag}"]
        lowered = html if self.classes else html.lower()
        self.left = sum(lowered.count(word) for word in words)
        try:
            self.feed(html)
            self.close()
        except NothingLeft:
            pass
        return self.sections

    def handle_starttag(self, tag, attrs):
        attrs = {name: value or "" for name, value in attrs}
        around = [section for _, section, _ in self.open if section is not None]
        for _, _, values, captions in around:
            if self.attribute in attrs:
                values.append(attrs[self.attribute])
            if tag == IMAGE_TAG:
                captions.append(attrs.get(self.attribute))
        pieces = section = None
        if tag == self.text_tag and around:
            pieces = []
            for _, texts, _, _ in around:
                texts.append(pieces)
        if tag == self.tag:
            matched = self.classes.intersection(attrs.get("class", "").split())
            if matched or not self.classes:
                section = (matched, [], [], [])
                self.sections.append(section)
                self.left -= len(matched) or 1
        if tag not in VOID_TAGS:
            self.open.append((tag, section, pieces))

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID_TAGS:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        for depth in range(len(self.open) - 1, -1, -1):
            if self.open[depth][0] == tag:
                del self.open[depth:]
                break
        if self.left <= 0 and all(section is None for _, section, _ in self.open):
            raise NothingLeft

    def handle_data(self, data):
        if self.open and self.open[-1][0] in SILENT_TAGS:
            return
        for _, _, pieces in self.open:
            if pieces is not None:
                pieces.append(data)


def section_text(html, tag="div", css_class="culture-content", text_tag="span", attribute="alt"):
    out = []
    for _, texts, values, _ in SectionReader(tag, [css_class] if css_class else [], text_tag, attribute).read(html):
        out += [piece for pieces in texts for piece in pieces] + values
    return "".join(out)


def first_captions(html, classes, tag="div", attribute="alt"):
    found = dict.fromkeys(classes, [None])
    for matched, _, _, captions in reversed(SectionReader(tag, classes, None, attribute).read(html)):
        found.update(dict.fromkeys(matched, captions or [None]))
    return [found[name][0] for name in classes]
