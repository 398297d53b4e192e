"""Elements of pages as rows, by a Python table function, and pairs from them.

The table function is the only Python: it reads a page once and gives one row
per start tag with attributes, the text inside, the parent and the texts and
captions beside it. What is a pair is decided in DataFrame operators.
"""

from __future__ import annotations

from collections.abc import Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairlake.functions.texts import mentions
from pairlake.functions.urls import path
from pairlake.functions.vocabulary import AFTER_WORDS, BEFORE_WORDS
from pairlake.operators import pairing
from pairlake.runtime import written

VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: A start tag of the first kind ends an open one of the second.
ENDS = {"p": {"p"}, "li": {"li"}, "td": {"td", "th"}, "th": {"td", "th"}, "tr": {"tr", "td", "th"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}}
HEADINGS = frozenset(["h1", "h2", "h3", "h4", "h5", "h6"])
ELEMENT = "pos int, tag string, attrs map<string,string>, text string, parent int, depth int, heading string, path string, last int, near string"
#: A picture's text is looked for in so many nodes after it.
NEAR = 3


class _Reader(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.rows: list[dict] = []
        self.open: list[int] = []
        self.heading = ""
        self.skip = False
        #: By position of the element around (-1: none), its texts (lists of parts) and elements (positions) in order.
        self.inside: dict[int, list[list[str] | int]] = {}

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        while self.open and self.rows[self.open[-1]]["tag"] in ENDS.get(tag, ()):
            self._close()
        path = "/".join(self.rows[k]["tag"] for k in self.open)
        row = {"pos": len(self.rows), "tag": tag, "attrs": {k: v or "" for k, v in attrs}, "text": [], "parent": self.open[-1] if self.open else -1, "depth": len(self.open), "heading": self.heading, "path": path}
        self.rows.append(row)
        self.inside.setdefault(row["parent"], []).append(row["pos"])
        if tag not in VOID:
            self.open.append(row["pos"])

    def _close(self) -> None:
        row = self.rows[self.open.pop()]
        row["last"] = len(self.rows) - 1
        if row["tag"] in HEADINGS:
            self.heading = " ".join("".join(row["text"]).split())

    def handle_endtag(self, tag: str) -> None:
        if tag in {self.rows[k]["tag"] for k in self.open}:
            while self.rows[self.open[-1]]["tag"] != tag:
                self._close()
            self._close()

    def handle_data(self, data: str) -> None:
        if self.open and self.rows[self.open[-1]]["tag"] not in ("script", "style"):
            for k in self.open:
                self.rows[k]["text"].append(data)
        if not self.open or self.rows[self.open[-1]]["tag"] not in ("script", "style"):
            nodes = self.inside.setdefault(self.open[-1] if self.open else -1, [])
            if nodes and isinstance(nodes[-1], list):
                nodes[-1].append(data)
            else:
                nodes.append([data])

    def near(self) -> dict[int, str]:
        """Texts of the ``NEAR`` nodes after each picture, texts and elements alike."""
        out = {}
        for nodes in self.inside.values():
            for k, at in enumerate(nodes):
                if isinstance(at, int) and self.rows[at]["tag"] == "img":
                    said = [x if isinstance(x, list) else self.rows[x]["text"] for x in nodes[k + 1 : k + 1 + NEAR]]
                    out[at] = " ".join("".join(t for part in said for t in part).split())
        return out


def read_elements(html: str | None) -> list[dict]:
    """One dict per start tag, in document order; unclosed and crossed tags are closed as browsers do for the common cases."""
    reader = _Reader()
    reader.feed(html or "")
    reader.close()
    end, near = len(reader.rows) - 1, reader.near()
    last = {k: end for k in reader.open}
    return [r | {"text": " ".join("".join(r["text"]).split()), "last": last.get(k, r.get("last", k)), "near": near.get(k)} for k, r in enumerate(reader.rows)]


def elements(pages: DataFrame, page_id: str = "page_id", html: str = "html") -> DataFrame:
    """(page_id, pos, tag, attrs, text, parent, depth, heading, path, last, near): one row per start tag; null pages give none.

    ``last`` is the position of the last element inside (its own where there is none), ``near`` the text of the
    three nodes after a picture.
    """
    kind = dict(pages.dtypes)[page_id]
    cols = [c.split()[0] for c in ELEMENT.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(i, *[e[c] for c in cols]) for i, h in zip(pdf[page_id], pdf[html]) for e in read_elements(h)]
            yield pd.DataFrame(rows, columns=[page_id, *cols])

    return pages.select(page_id, html).where(F.col(html).isNotNull()).mapInPandas(run, f"{page_id} {kind}, {ELEMENT}")


def attribute(name: str) -> Column:
    return F.try_element_at("attrs", F.lit(name))


def links(els: DataFrame, page_id: str = "page_id") -> DataFrame:
    """(page_id, pos, href, text, rel, class, label) of links."""
    return els.where("tag = 'a'").select(page_id, "pos", attribute("href").alias("href"), "text", attribute("rel").alias("rel"), attribute("class").alias("class"), attribute("aria-label").alias("label")).where("href is not null")


def images(els: DataFrame, page_id: str = "page_id") -> DataFrame:
    """(page_id, pos, parent, src, alt, class, caption, heading, near, n_siblings): pictures with what is said about them.

    ``caption`` is the text of the figure around a picture, else of the paragraph or division that follows it.
    """
    own = els.where("tag in ('img', 'p', 'span', 'div', 'caption', 'figcaption')")
    # the nearest text after an element is the last one before it in falling order, a running frame
    after = Window.partitionBy(page_id, "parent").orderBy(F.desc("pos")).rowsBetween(Window.unboundedPreceding, -1)
    own = own.withColumn("next_text", F.last(F.when(F.col("tag") != "img", F.col("text")), ignorenulls=True).over(after))
    pics = own.where("tag = 'img'").select(page_id, "pos", "parent", "next_text", F.coalesce(attribute("src"), attribute("data-src")).alias("src"), attribute("alt").alias("alt"), attribute("class").alias("class"), "attrs", "heading", "near")
    around = els.select(page_id, F.col("pos").alias("parent"), F.col("tag").alias("around"), F.col("attrs").alias("around_attrs"), F.col("text").alias("around_text"))
    same = pics.groupBy(page_id, "parent").agg(F.count(F.lit(1)).alias("n_siblings"))
    out = pics.join(around, [page_id, "parent"], "left").join(same, [page_id, "parent"], "left")
    return out.withColumn("caption", F.when(F.col("around") == "figure", F.col("around_text")).otherwise(F.col("next_text"))).drop("around_text")


def picture_context(most: int = 300) -> Column:
    """What is said around a picture: alternative text, label, caption or following text, heading; cut at ``most`` characters."""
    parts = [F.col("alt"), attribute("aria-label"), F.col("caption"), F.col("heading")]
    return F.substring(F.array_join(F.filter(F.array(*parts), lambda t: F.coalesce(t, F.lit("")) != ""), " "), 1, most)


def attribute_pairs(els: DataFrame, before: str = "data-before", after: str = "data-after", page_id: str = "page_id") -> DataFrame:
    """Both pictures named in attributes of one element."""
    b, a = attribute(before), attribute(after)
    return els.where(b.isNotNull() & a.isNotNull()).select(page_id, "pos", b.alias("before"), a.alias("after"))


def side(*texts: Column) -> Column:
    """'before' or 'after' by the words in any of the texts; before is tried first."""
    t = F.concat_ws(" ", *texts)
    return F.when(mentions(t, BEFORE_WORDS), "before").when(mentions(t, AFTER_WORDS), "after")


def structural_score(before_strong: Column, before_weak: Column, after_strong: Column, after_weak: Column) -> Column:
    """0.45 for a side with a strong sign, 0.1 for one with a weak sign only."""
    one = lambda s, w: F.when(s, 0.45).when(w, 0.1).otherwise(0.0)
    return F.round(one(before_strong, before_weak) + one(after_strong, after_weak), 2)


def picture_signs(pics: DataFrame, page_id: str = "page_id") -> DataFrame:
    """(page_id, src, strong_before, strong_after, weak): what speaks for each side; a sign is weak if only the position in a pair speaks."""
    said = F.concat_ws(" ", F.array_join(F.map_values("attrs"), " "), F.array_join(F.map_values(F.coalesce("around_attrs", F.create_map().cast("map<string,string>"))), " "), "caption")
    rows = pics.select(page_id, "src", mentions(said, BEFORE_WORDS).alias("b"), mentions(said, AFTER_WORDS).alias("a"), (F.col("n_siblings") == 2).alias("w"))
    return rows.where("src is not null").groupBy(page_id, "src").agg(F.max("b").alias("strong_before"), F.max("a").alias("strong_after"), F.max("w").alias("weak"))


def slide_pairs(els: DataFrame, pics: DataFrame, page_id: str = "page_id") -> DataFrame:
    """(page_id, n, before, after): the first two pictures of each slide, then slides named before and after, zipped; each pair once."""
    c = F.coalesce(attribute("class"), F.lit(""))
    slide = F.contains(c, F.lit("slide")) | F.contains(c, F.lit("Slide")) | F.contains(c, F.lit("carousel-item")) | attribute("data-slide-index").isNotNull()
    slide = slide | ((F.col("tag") == "li") & F.contains(c, F.lit("gallery")))
    slides = els.where(slide).select(page_id, F.col("pos").alias("slide"), "last", F.col("text").alias("label"))
    held = slides.join(pics.select(page_id, "pos", "src", "alt"), page_id).where("pos > slide and pos <= last")
    whole = held.groupBy(page_id, "slide").agg(F.min_by("src", "pos").alias("src"), F.array_join(F.collect_list("alt"), " ").alias("alts"), F.first("label").alias("label"))
    dual = pairing.first_two(held, [page_id, "slide"], ["pos"], "src").select(page_id, F.lit(0).alias("kind"), F.col("slide").alias("k"), "before", "after")
    cross = pairing.zip_pairs(whole, [page_id], side(F.col("label"), F.col("alts")), ["slide"], "src").select(page_id, F.lit(1).alias("kind"), F.col("n").alias("k"), "before", "after")
    once = pairing.first_wins(dual.unionByName(cross), [page_id, "before", "after"], ["kind", "k"])
    return once.select(page_id, F.row_number().over(Window.partitionBy(page_id).orderBy("kind", "k")).alias("n"), "before", "after")


#: Strategies of ``candidate_pairs`` as they are tried.
TRIED = [1, 2, 5, 3, 6, 4]


def candidate_pairs(pages: DataFrame, page_id: str = "page_id", html: str = "html") -> DataFrame:
    """(page_id, strategy, n, before, after) by the first strategy that finds pairs on a page.

    1 both in one element's attributes; 2 figures whose caption speaks of a pair, first two pictures;
    3 pictures named before and after, zipped; 4 containers of pictures, neighbours; 5 slides; 6 pictures
    followed by texts that speak of before and after, zipped. They are tried in the order of ``TRIED``.
    """
    # six strategies read them, pages are parsed once
    els = written(elements(pages, page_id, html), "elements")
    pics = written(images(els, page_id).where("src is not null"), "pictures")
    one = attribute_pairs(els, page_id=page_id).withColumns({"n": F.row_number().over(Window.partitionBy(page_id).orderBy("pos")), "strategy": F.lit(1)})
    figures = pics.where((F.col("around") == "figure") & mentions(F.col("caption"), BEFORE_WORDS) & mentions(F.col("caption"), AFTER_WORDS))
    two = pairing.first_two(figures, [page_id, "parent"], ["pos"], "src").withColumns({"n": F.row_number().over(Window.partitionBy(page_id).orderBy("parent")), "strategy": F.lit(2)})
    three = pairing.zip_pairs(pics, [page_id], side(F.col("alt"), F.col("src"), F.col("class")), ["pos"], "src").withColumn("strategy", F.lit(3))
    four = pairing.adjacent_pairs(pics.where("n_siblings >= 2"), [page_id, "parent"], ["pos"], "src").withColumn("strategy", F.lit(4))
    five = slide_pairs(els, pics, page_id).withColumn("strategy", F.lit(5))
    six = pairing.zip_pairs(pics, [page_id], side(F.col("near")), ["pos"], "src").withColumn("strategy", F.lit(6))
    cols = [page_id, "strategy", "n", "before", "after"]
    every = one.select(*cols)
    for found in (two, three, four, five, six):
        every = every.unionByName(found.select(*cols))
    tried = F.array_position(F.array(*[F.lit(k) for k in TRIED]), F.col("strategy"))
    return pairing.first_strategy(every.withColumn("tried_", tried), [page_id], "tried_").drop("tried_")


def figure_pairs(pics: DataFrame, either: bool = False, page_id: str = "page_id") -> DataFrame:
    """(page_id, n, before, after): first two pictures of figures whose caption speaks of before and after, or with ``either`` of one of them."""
    b, a = mentions(F.col("caption"), BEFORE_WORDS), mentions(F.col("caption"), AFTER_WORDS)
    figures = pics.where((F.col("around") == "figure") & ((b | a) if either else (b & a)))
    return pairing.first_two(figures, [page_id, "parent"], ["pos"], "src").withColumn("n", F.row_number().over(Window.partitionBy(page_id).orderBy("parent"))).select(page_id, "n", "before", "after")


#: Bits of the signs that an element gives: three of a picture itself, then its attributes and its text for pictures in and beside it.
DATA, ALT, CLASS, AROUND, SAID = 1, 2, 4, 8, 16
#: Elements whose text is a picture's caption if they follow it, or hold it.
FOLLOWING, HOLDING = ("p", "span", "div", "caption", "figcaption"), "figure"


def _signs(words: list[str]) -> Column:
    """Bits of what an element says of the words."""
    picture, no_map = F.col("tag") == "img", F.create_map().cast("map<string,string>")
    attrs = F.coalesce("attrs", no_map)
    bit = lambda where, text, value: F.when(where & mentions(text, words), value).otherwise(0)
    own = bit(picture, F.array_join(F.concat(F.map_keys(attrs), F.map_values(attrs)), " "), DATA) + bit(picture, attribute("alt"), ALT) + bit(picture, attribute("class"), CLASS)
    return own + bit(~picture, F.array_join(F.map_values(attrs), " "), AROUND) + bit(F.col("tag").isin(*FOLLOWING, HOLDING), F.col("text"), SAID)


def signals(els: DataFrame, wanted: DataFrame, page_id: str = "page_id") -> DataFrame:
    """(page_id, url, side, strong, weak) of wanted pictures (page_id, url, side): which signs speak for their side.

    ``strong`` holds the kinds of sign in fixed order: filename, data_attr, alt_text, css_class, parent_attr (up to
    six elements around), caption; ``weak`` says whether the picture is in its side's place of two.

    All that speaks for a picture is on its page: a page's elements are brought together once, as numbers and bits, and
    meet the page's wanted pictures in one join. The plan has two exchanges however many kinds of sign there are. The
    join is a merge join whatever Spark takes the pages' size for: it knows one element a page and not what the parser
    gives, so by its own choice it would send all pages of some million rows to the driver as one table.
    """
    src = F.when(F.col("tag") == "img", F.coalesce(F.nullif(attribute("src"), F.lit("")), attribute("data-src"), F.lit("")))
    follows = F.col("tag").isin(*FOLLOWING) & F.col("text").isNotNull()
    element = F.struct("pos", "parent", "depth", "last", src.alias("src"), follows.alias("follows"), (F.col("tag") == HOLDING).alias("figure"), _signs(BEFORE_WORDS).alias("b"), _signs(AFTER_WORDS).alias("a"))
    pages = els.where("tag is not null").select(page_id, element.alias("e")).groupBy(page_id).agg(F.collect_list("e").alias("els_"))
    # an address's path is taken out before the groups, else it would be for each element
    own = F.struct("url", "side", F.substring_index(path(F.col("url")), "/", -1).alias("name"), path(F.col("url")).alias("path"))
    rows = wanted.select(page_id, own.alias("w")).groupBy(page_id).agg(F.collect_set("w").alias("ws")).join(pages.hint("merge"), page_id, "left").select(page_id, F.explode("ws").alias("w"), F.coalesce("els_", F.array().cast(pages.schema["els_"].dataType)).alias("els_"))
    w = F.col("w")
    signs = lambda e: F.when(w["side"] == "before", e["b"]).otherwise(e["a"])
    has = lambda bits, bit: F.coalesce(bits.bitwiseAND(F.lit(bit)) != 0, F.lit(False))
    hit = lambda e: F.contains(e["src"], w["url"]) | ((w["name"] != "") & F.contains(e["src"], w["name"]))
    pick = lambda where, *values: F.array_min(F.transform(F.filter("els_", where), lambda e: F.struct(e["pos"].alias("pos"), *[v(e) for v in values])))
    rows = rows.withColumn("pic", pick(lambda e: e["src"].isNotNull() & hit(e), lambda e: e["parent"].alias("parent"), lambda e: e["depth"].alias("depth"), lambda e: signs(e).alias("signs")))
    pic = F.col("pic")
    around = lambda e: (e["pos"] < pic["pos"]) & (pic["pos"] <= e["last"]) & (e["depth"] >= pic["depth"] - 6)
    beside = lambda e: e["parent"] == pic["parent"]
    bits = lambda e: signs(e).alias("signs")
    rows = rows.withColumns({
        "parent_attr": F.exists("els_", lambda e: e["src"].isNull() & around(e) & has(signs(e), AROUND)),
        "figure": pick(lambda e: e["figure"] & (e["pos"] == pic["parent"]), bits),
        "next": pick(lambda e: e["follows"] & beside(e) & (e["pos"] > pic["pos"]), bits),
        "places": F.transform(F.filter("els_", lambda e: e["src"].isNotNull() & beside(e)), lambda e: e["pos"]),
    })
    no = F.lit(False)
    kinds = {
        "filename": F.when(w["side"] == "before", mentions(w["path"], BEFORE_WORDS)).otherwise(mentions(w["path"], AFTER_WORDS)), "data_attr": has(pic["signs"], DATA), "alt_text": has(pic["signs"], ALT),
        "css_class": has(pic["signs"], CLASS), "parent_attr": F.coalesce("parent_attr", no), "caption": has(F.when(F.col("figure").isNotNull(), F.col("figure")["signs"]).otherwise(F.col("next")["signs"]), SAID),
    }
    strong = F.filter(F.array(*[F.when(c, F.lit(k)) for k, c in kinds.items()]), lambda x: x.isNotNull())
    first = F.array_min("places") == pic["pos"]
    weak = F.coalesce((F.size("places") == 2) & F.when(w["side"] == "before", first).otherwise(~first), no)
    return rows.select(page_id, "w.url", "w.side", strong.alias("strong"), weak.alias("weak"))


def scored_pairs(found: DataFrame, by: list[str]) -> DataFrame:
    """(by, score, explicit): the structural score of both sides of pairs, and whether each side has a strong sign (gate 1)."""
    side = lambda s, c: F.max(F.when(F.col("side") == s, c))
    strong = F.size("strong") > 0
    out = found.groupBy(*by).agg(*[side(s, c).alias(f"{n}_{s}") for s in ("before", "after") for n, c in (("strong", strong), ("weak", F.col("weak")))])
    no = F.lit(False)
    out = out.withColumns({c: F.coalesce(c, no) for c in ("strong_before", "weak_before", "strong_after", "weak_after")})
    score = structural_score(F.col("strong_before"), F.col("weak_before"), F.col("strong_after"), F.col("weak_after"))
    return out.select(*by, score.alias("score"), (F.col("strong_before") & F.col("strong_after")).alias("explicit"))


def cards(els: DataFrame, page_id: str = "page_id") -> DataFrame:
    """(page_id, treatment_name, provider_name, date_posted): the first of each on a card."""
    first = lambda c: F.min_by(c, F.when(c.isNotNull(), F.col("pos")))
    date = F.when(F.col("tag") == "time", attribute("datetime"))
    return els.groupBy(page_id).agg(first(attribute("data-treatment-name")).alias("treatment_name"), first(attribute("data-provider-name")).alias("provider_name"), first(date).alias("date_posted"))


def dispatched(address: Column, keys: dict[str, str], default: str | None = None) -> Column:
    """What is configured for the first key, in their order, that an address holds."""
    out = F.lit(default).cast("string")
    for k, v in reversed(list(keys.items())):
        out = F.when(F.contains(address, F.lit(k)), F.lit(v)).otherwise(out)
    return out


LISTING = "data struct<after:string, children:array<struct<data:struct<title:string, permalink:string, is_gallery:boolean, media_metadata:map<string,struct<status:string, s:struct<u:string,gif:string>>>>>>>"


def listing_pairs(listings: DataFrame, page_id: str = "page_id", body: str = "body") -> DataFrame:
    """(page_id, permalink, n, before, after) from JSON listings: valid gallery pictures of posts titled as pairs, halves."""
    posts = listings.select(page_id, F.explode(F.from_json(body, LISTING)["data"]["children"]["data"]).alias("post")).where("post.is_gallery")
    titled = posts.where(F.lower("post.title").rlike(r"before|after|\bb\s*[/&]\s*a\b|antes|depois|전후|전|후"))
    media = titled.select(page_id, F.col("post.permalink").alias("permalink"), F.posexplode(F.map_values("post.media_metadata")).alias("pos", "m")).where("m.status = 'valid'")
    urls = media.select(page_id, "permalink", "pos", F.replace(F.coalesce("m.s.u", "m.s.gif"), F.lit("&amp;"), F.lit("&")).alias("url")).where("url is not null")
    return pairing.half_split(urls, [page_id, "permalink"], ["pos"], "url")


def script_images(pages: DataFrame, page_id: str = "page_id", html: str = "html") -> DataFrame:
    """(page_id, pos, url, description): picture URLs in inline scripts, the i-th with the i-th description."""
    urls = F.regexp_extract_all(html, F.lit(r'"url"\s*:\s*"(https?:[^"]+?\.(?:jpg|jpeg|png|webp))"'), 1)
    said = F.regexp_extract_all(html, F.lit(r'"description"\s*:\s*"([^"]*)"'), 1)
    both = F.transform(urls, lambda u, k: F.struct(F.replace(u, F.lit("\\/"), F.lit("/")).alias("url"), F.try_element_at(said, k + 1).alias("description")))
    return pages.where(F.col(html).isNotNull()).select(page_id, F.posexplode(both).alias("pos", "x")).select(page_id, "pos", "x.url", "x.description")
