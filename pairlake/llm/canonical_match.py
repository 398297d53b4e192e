"""Freely typed values to entries of a reference list, by trie and automaton.

The names of the reference entries and their aliases (names in other
languages) are spelled into a trie, and so are alias paths, their words in
alphabetical order. A value is searched in
it with a Levenshtein automaton in bit-parallel form: at a trie node the
automaton's state is one bit set per number of edits (insert, delete, replace,
transpose), whose bit i says that the first i letters of the value agree with the
node's path; a branch is left as soon as the sets are empty. All entries within
a limit that depends on the value's length are returned (``within``).

One entry is then chosen for a value (``map_labels``). Letters are folded (width, case,
accents, look-alike letters and digits), and what is added around a name (quantities, notes,
prefixes) is taken off. Additions are learnt from the values themselves: what stands beside
a name that is spelled exactly, with numbers as such, is an addition if it is seen beside at
least ``LEARNT`` different entries and isn't near a word of an entry; none is dropped for its
length or rank. Up to ``ADDITIONS`` of them are sent to executors as a set; if there are more,
each value is joined with those that occur in it. The trie is asked in a
fixed order, and the first answer that names one entry
holds: path spelled exactly (whole value, then its parts), words in any order, then the
automaton with rising edits (the nearest entry; of equally near ones none is taken), and a
beginning of one entry.

Distinct values only are searched: labels are first reduced to distinct
(field, value) with partial aggregation, so a value that holds a third of all
rows is searched once, and the result is joined back on the value. Distinct
values are spread evenly over tasks.

The trie is sent to executors; ``MAX_ENTRIES`` bounds it. A longer reference
list is searched in blocks of that many entries, the answers of all blocks are
put together, and the choice is made among them, so it is that of a single block.

Cases: null and blank values give no row; a value without an entry within the
limit, or with two different entries equally near, gets 0; repeated labels give
one row; values of any length are searched.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairlake.llm.textnorm import INVISIBLE, fold
from pairlake.runtime import bounded, cut

MAX_ENTRIES = 100_000

# Digits and signs typed for letters.
LEET = {"0": "o", "1": "il", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s", "!": "i", "|": "l"}
#: An addition is seen beside so many different entries; so many are sent to executors as a set.
LEARNT, ADDITIONS = 3, 10_000
TOKEN = re.compile(r"\d+(?:[.,]\d+)?|[^\W\d_]+")
SIGNS = re.compile(r"[®™©℠]|\(\s*(?:tm|r|c)\s*\)", re.I)
WORDS = re.compile(r"[^\W_]+")
JAMO = re.compile("[ᄀ-ᇿ가-힣]")


def letters(s: str) -> str:
    """Letters and digits only; Hangul taken apart so that one letter is one edit."""
    s = re.sub(r"[\W_]+", "", s)
    return unicodedata.normalize("NFKD", s) if JAMO.search(s) else s


def parts(value: str) -> list[str]:
    """The words and numbers of a folded value."""
    return TOKEN.findall(fold(SIGNS.sub(" ", INVISIBLE.sub("", value))))


def shape(tokens: list[str]) -> str:
    """Words with numbers as such."""
    return " ".join("#" if t[0].isdigit() else t for t in tokens)


def reach(additions: frozenset[tuple[str, str]]) -> int:
    """Words of the longest addition."""
    return max((x.count(" ") + 1 for _, x in additions), default=0)


def trimmed(value: str, additions: frozenset[tuple[str, str]] = frozenset(), longest: int | None = None) -> str:
    """The folded value without signs, outer punctuation and additions ((side, shape), side left or right; longest: their words)."""
    longest = reach(additions) if longest is None else longest
    s = fold(SIGNS.sub(" ", INVISIBLE.sub("", value)))
    at = [x.span() for x in TOKEN.finditer(s)]
    said = [s[a:b] for a, b in at]
    low, high, before = 0, len(at), None
    while before != (low, high):
        before = low, high
        for k in range(min(longest, high - low - 1), 0, -1):
            if ("right", shape(said[high - k : high])) in additions:
                high -= k
                break
        for k in range(min(longest, high - low - 1), 0, -1):
            if ("left", shape(said[low : low + k])) in additions:
                low += k
                break
    return s[at[low][0] : at[high - 1][1]] if at else s.strip()


def limit(n: int) -> int:
    """Edits allowed for a name of n letters."""
    return 0 if n < 4 else 1 if n < 6 else 2 if n < 8 else 3


class Trie:
    """Reference entries and their alias paths, searched with a Levenshtein automaton."""

    def __init__(self, entries: list[tuple[int, str, list[str | None]]], additions: frozenset[tuple[str, str]] = frozenset()) -> None:
        self.root: dict = {}
        self.word_root: dict = {}
        self.longest = 0
        self.free_of(additions)
        for term, name, aliases in entries:
            for x in [name, *aliases]:
                if x and (s := letters(fold(x))):
                    self._add(s, term, self.root)
                    self.longest = max(self.longest, len(s))
                if x and len(w := WORDS.findall(fold(x))) > 1:
                    self._add(" ".join(sorted(w)), term, self.word_root)

    def free_of(self, additions: frozenset[tuple[str, str]]) -> None:
        """Sets what is taken off values."""
        self.additions, self.reach = additions, reach(additions)

    @staticmethod
    def _add(s: str, term: int, node: dict) -> None:
        for c in s:
            node = node.setdefault(c, {})
        node.setdefault("", set()).add(term)

    @staticmethod
    def spelled(s: str, node: dict) -> set[int]:
        """Entries whose path is s itself: the automaton with no edits allowed has one state."""
        for c in s:
            node = node.get(c)
            if node is None:
                return set()
        return node.get("", set())

    def search(self, s: str, most: int, root: dict | None = None) -> dict[int, int]:
        """Entries within ``most`` edits of s (insert, delete, replace, transpose), each with its distance.

        Bit i of the set of e edits: the first i letters of s are within e edits of the path.
        """
        n, found = len(s), {}
        if n > self.longest + most:
            return found
        whole, goal = (2 << n) - 1, 1 << n
        typed: dict[str, int] = {}
        alike: dict[str, int] = {}
        for k, c in enumerate(s):
            typed[c] = typed.get(c, 0) | 2 << k
            for x in LEET.get(c, ""):
                alike[x] = alike.get(x, 0) | 2 << k
        fits = {c: typed.get(c, 0) | alike.get(c, 0) for c in {*typed, *alike}}
        stack = [(self.root if root is None else root, "", [(2 << e) - 1 & whole for e in range(most + 1)], None)]
        while stack:
            node, last, sets, before = stack.pop()
            if "" in node and sets[most] & goal:
                e = next(e for e, x in enumerate(sets) if x & goal)
                for term in node[""]:
                    found[term] = min(e, found.get(term, most))
            for c, child in node.items():
                if not c:
                    continue
                fit, swap = fits.get(c, 0), typed.get(c, 0) << 1 & typed.get(last, 0)
                x = sets[0] << 1 & fit
                new = [x]
                for e in range(1, most + 1):
                    fewer = sets[e - 1]
                    x = (sets[e] << 1 & fit | fewer | fewer << 1 | x << 1) & whole
                    if swap and before is not None:
                        x |= before[e - 1] << 2 & swap
                    new.append(x)
                if x:
                    stack.append((child, c, new, sets))
        return found

    def starting_with(self, s: str) -> dict[int, str]:
        """Entries of which s is a beginning, each with the length of s and its names that s begins."""
        node = self.root
        for c in s:
            hit = node.get(c) or next((node[x] for x in LEET.get(c, "") if x in node), None)
            if hit is None:
                return {}
            node = hit
        todo: list[tuple[dict, str]] = [(node, "")]
        names: dict[int, list[str]] = {}
        while todo:
            x, rest = todo.pop()
            for c, child in x.items():
                if c:
                    todo.append((child, rest + c))
                else:
                    for term in child:
                        names.setdefault(term, []).append(rest)
        return {t: "\0".join([str(len(s)), *sorted(r, key=lambda x: (len(x), x))]) for t, r in names.items()}

    def beside(self, value: str) -> tuple[int, int, list[str], list[str]] | None:
        """(letters, entry, words before, words after) of the longest run of words that spells one entry."""
        said, best = parts(value), None
        for i in range(len(said)):
            node, n = self.root, 0
            for j in range(i, len(said)):
                for c in letters(said[j]):
                    node = node.get(c)
                    n += 1
                    if node is None:
                        break
                if node is None:
                    break
                if len(node.get("", ())) == 1 and (best is None or n > best[0]):
                    best = n, next(iter(node[""])), said[:i], said[j + 1 :]
        return best

    def answers(self, value: str) -> Iterator[tuple[int, str, int, dict[int, str]]]:
        """What the trie says about a value, in the order in which it counts: (group, kind, distance, {entry: what tells it apart})."""
        plain = trimmed(value, self.additions, self.reach)
        whole = letters(fold(INVISIBLE.sub("", value)))
        seen: list[str] = []
        for part in (plain, *halves(plain)):
            s = letters(part)
            if s and s not in seen:
                seen.append(s)
        one = lambda terms: dict.fromkeys(terms, "")
        for s in [whole, *seen]:
            yield 0, "spelled", 0, one(self.spelled(s, self.root))
        yield 1, "words", 0, one(self.spelled(" ".join(sorted(WORDS.findall(plain))), self.word_root))
        for group, s in enumerate([seen[-1], *seen[:1]] if len(seen) > 1 else seen, 3):
            most = limit(len(s))
            for k in range(1, most + 1):
                found = self.search(s, k)
                yield group, "near", k, one(t for t, d in found.items() if d == min(found.values()))
            yield group, "beginning", most + 1, self.starting_with(s) if len(s) >= 4 else {}

    def match(self, value: str) -> tuple[int, int]:
        """(entry or 0, distance); 0 also if two entries are equally near."""
        return decided(self.answers(value))


def begun(hits: dict[int, str]) -> int:
    """The entry that a beginning stands for: the only one, or one whose name begins all the others; at least half of it is typed."""
    rests = {t: x.split("\0") for t, x in hits.items()}
    first = sorted(rests, key=lambda t: len(rests[t][1]))
    base = rests[first[0]][1]
    if len(first) > 1 and (len(rests[first[1]][1]) == len(base) or not all(any(r.startswith(base) for r in x[1:]) for x in rests.values())):
        return 0
    return first[0] if len(base) <= int(rests[first[0]][0]) else 0


def decided(answers: Iterable[tuple[int, str, int, dict[int, str]]]) -> tuple[int, int]:
    """(entry or 0, distance) by the first answer that names one entry."""
    tied = None
    for group, kind, distance, hits in answers:
        if not hits or group == tied:
            continue
        if kind == "beginning":
            term = begun(hits)
        else:
            least = min(hits.values())
            low = [t for t, x in hits.items() if x == least]
            term = low[0] if len(low) == 1 else 0
        if term:
            return term, distance
        if kind == "near":
            # equally near entries: what else is tried for the same letters can't be nearer
            tied = group
    return 0, -1


def halves(s: str) -> list[str]:
    """The name in a value that says it twice ("X; X", "X + X", "X X")."""
    parts = [p.strip() for p in re.split(r"\s*[;+&|]\s*|\s+/\s+|\s*,\s+", s) if p.strip()]
    if len(parts) > 1 and len({letters(p) for p in parts}) == 1:
        return [parts[0]]
    w = s.split()
    if len(w) > 1 and len(w) % 2 == 0 and w[: len(w) // 2] == w[len(w) // 2 :]:
        return [" ".join(w[: len(w) // 2])]
    return []


def _blocks(terms: DataFrame) -> list[list[tuple[int, str, str, list[str]]]]:
    """The reference list in blocks of at most ``MAX_ENTRIES`` entries."""
    blocks: list[list] = [[]]
    cols = [c for c in terms.columns if c not in ("term_id", "kind", "name")]
    for r in terms.where("term_id is not null and kind is not null and name is not null").distinct().toLocalIterator():
        if len(blocks[-1]) >= MAX_ENTRIES:
            blocks.append([])
        blocks[-1].append((int(r["term_id"]), r["kind"], r["name"], [r[c] for c in cols if isinstance(r[c], str)]))
    return blocks


def _searched(values: DataFrame, block: list, additions: frozenset | None, per_value, schema: str) -> DataFrame:
    """Rows (kind, value, ...) that ``per_value(trie, value)`` gives for each distinct value; without additions values bring their own."""
    sent = values.sparkSession.sparkContext.broadcast((block, additions))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own, added = sent.value
        tries = {k: Trie([(i, n, a) for i, kk, n, a in own if kk == k], added or frozenset()) for k in {x[1] for x in own}}
        nothing = Trie([])
        for pdf in batches:
            rows = []
            for j, (k, v) in enumerate(zip(pdf["kind"], pdf["value"])):
                trie = tries.get(k, nothing)
                if added is None:
                    trie.free_of(frozenset(tuple(x.split(" ", 1)) for x in pdf["added"].iat[j]))
                rows += [(k, v, *r) for r in per_value(trie, v)]
            yield pd.DataFrame(rows, columns=[x.split()[0] for x in schema.split(", ")])

    return values.select("kind", "value", *["added"] * (additions is None)).mapInPandas(run, schema)


def spread(values: DataFrame) -> DataFrame:
    """The same values, as many in each task; they are read twice."""
    return cut(values.select("kind", "value").repartition(int(values.sparkSession.conf.get("spark.sql.shuffle.partitions")), F.xxhash64("value", "kind")))


def additions(values: DataFrame, blocks: list[list]) -> DataFrame:
    """(side, shape): all additions, which stand beside at least ``LEARNT`` entries."""

    def sides(trie: Trie, value: str) -> list[tuple]:
        if not (found := trie.beside(value)):
            return []
        n, term, *around = found
        return [(n, term, *[x for w in around for x in ((shape(w), " ".join(w)) if w else (None, None))])]

    schema = "kind string, value string, n int, term_id long, left string, left_raw string, right string, right_raw string"
    every = None
    for b in blocks:
        own = _searched(values, b, frozenset(), sides, schema)
        every = own if every is None else every.unionByName(own)
    if len(blocks) > 1:
        best = F.max_by(F.struct("term_id", "left", "left_raw", "right", "right_raw"), F.struct("n", "term_id"))
        every = every.groupBy("kind", "value").agg(best.alias("x")).select("kind", "value", "x.*")
    side = lambda s: F.struct(F.lit(s).alias("side"), F.col(s).alias("shape"), F.col(f"{s}_raw").alias("raw"))
    shapes = every.select("kind", "term_id", F.explode(F.array(side("left"), side("right"))).alias("x")).select("kind", "term_id", "x.*").where("shape is not null")
    counted = shapes.groupBy("side", "shape").agg(F.count_distinct("kind", "term_id").alias("n"), F.min("raw").alias("raw")).where(F.col("n") >= LEARNT)
    # a misspelt word of an entry stands beside many entries too
    own = sorted({w for b in blocks for _, _, n, al in b for x in (n, *al) for w in parts(x)})
    sent = values.sparkSession.sparkContext.broadcast(own)

    def kept(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        words = Trie([(k, w, []) for k, w in enumerate(sent.value, 1)])
        near = lambda w: bool(words.search(s := letters(w), limit(len(s))))
        for pdf in batches:
            yield pdf.loc[[not near(x) and not any(near(w) for w in x.split()) for x in pdf["raw"]], ["side", "shape"]]

    return cut(counted.select("side", "shape", "raw").mapInPandas(kept, "side string, shape string"))


def learnt(values: DataFrame, blocks: list[list]) -> frozenset[tuple[str, str]]:
    """All additions (side, shape) as a set."""
    return frozenset((r["side"], r["shape"]) for r in additions(values, blocks).collect())


def with_additions(values: DataFrame, blocks: list[list]) -> tuple[DataFrame, frozenset[tuple[str, str]] | None]:
    """(values, additions), or if there are more than ``ADDITIONS`` (values with those that occur in each, None)."""
    found = additions(values, blocks)
    if bounded(found, ADDITIONS):
        return values, frozenset((r["side"], r["shape"]) for r in found.collect())
    longest = found.agg(F.max(F.size(F.split("shape", " ")))).first()[0]
    numbered = cut(values.select("kind", "value").withColumn("no", F.monotonically_increasing_id()))

    def runs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for no, value in zip(pdf["no"], pdf["value"]):
                said = [shape([t]) for t in parts(value)]
                rows += [(no, x) for x in {" ".join(said[i : i + k]) for k in range(1, min(longest, len(said) - 1) + 1) for i in range(len(said) - k + 1)}]
            yield pd.DataFrame(rows, columns=["no", "shape"])

    held = numbered.select("no", "value").mapInPandas(runs, "no long, shape string").join(found, "shape")
    each = held.groupBy("no").agg(F.collect_set(F.concat_ws(" ", "side", "shape")).alias("added"))
    own = numbered.join(each, "no", "left").select("kind", "value", F.coalesce("added", F.array().cast("array<string>")).alias("added"))
    return cut(own), None


def match_values(values: DataFrame, terms: DataFrame) -> DataFrame:
    """(kind, value, term_id, distance) of distinct (kind, value); terms: term_id, kind, name, aliases."""
    blocks = _blocks(terms)
    values, added = with_additions(spread(values), blocks)
    if len(blocks) == 1:
        return _searched(values, blocks[0], added, lambda trie, v: [trie.match(v)], "kind string, value string, term_id long, distance int")
    said = "kind string, value string, place int, grp int, route string, distance int, term_id long, apart string"
    every = None
    for b in blocks:
        # a row without an entry keeps the place of an empty answer
        own = _searched(values, b, added, lambda trie, v: [(k, g, r, d, t, x) for k, (g, r, d, h) in enumerate(trie.answers(v)) for t, x in (h or {0: ""}).items()], said)
        every = own if every is None else every.unionByName(own)

    def choose(pdf: pd.DataFrame) -> pd.DataFrame:
        # an answer's nearest entries are those of the block where they are nearest
        answers = []
        for (_, g, r, d), own in pdf.groupby(["place", "grp", "route", "distance"]):
            answers.append((int(g), r, int(d), {t: x for t, x in zip(own["term_id"], own["apart"]) if t}))
        term, distance = decided(answers)
        return pdf[["kind", "value"]].head(1).assign(term_id=term, distance=distance)

    return every.groupBy("kind", "value").applyInPandas(choose, "kind string, value string, term_id long, distance int")


def within(values: DataFrame, terms: DataFrame) -> DataFrame:
    """(kind, value, term_id, distance): all entries within the limit of distinct (kind, value), folded and freed of additions."""
    blocks, out = _blocks(terms), None
    values, added = with_additions(spread(values), blocks)

    def found(trie: Trie, value: str) -> Iterable[tuple[int, int]]:
        s = letters(trimmed(value, trie.additions, trie.reach))
        return trie.search(s, limit(len(s))).items() if s else ()

    for b in blocks:
        own = _searched(values, b, added, found, "kind string, value string, term_id long, distance int")
        out = own if out is None else out.unionByName(own)
    return out.groupBy("kind", "value", "term_id").agg(F.min("distance").alias("distance"))


def long_values(labels: DataFrame, fields: dict[str, str], id_col: str = "id") -> DataFrame:
    """(label_id, field, value, kind) of all non-blank values of ``fields`` (column -> kind), each once."""
    kinds = F.create_map(*[F.lit(x) for kv in fields.items() for x in kv])
    return (
        labels.select(F.col(id_col).alias("label_id"), F.explode(F.map_from_arrays(F.array(*[F.lit(f) for f in fields]), F.array(*[F.col(f) for f in fields]))).alias("field", "value"))
        .where(F.col("value").isNotNull() & F.col("value").rlike(r"[^\s\p{Z}\p{C}]") & F.col("label_id").isNotNull())
        .distinct()
        .withColumn("kind", kinds[F.col("field")])
    )


def map_labels(labels: DataFrame, terms: DataFrame, fields: dict[str, str], id_col: str = "id") -> DataFrame:
    """(label_id, field, value, term_id, distance) of all non-blank values of ``fields`` (column -> kind).

    Values that are letter for letter an entry's name get that entry and distance 0.
    """
    long = long_values(labels, fields, id_col)
    names = terms.select("kind", F.col("name").alias("value"), F.col("term_id").alias("own_id")).where("term_id is not null").groupBy("kind", "value").agg(F.min("own_id").alias("own_id"))
    distinct = long.select("kind", "value").distinct()
    todo = distinct.join(names, ["kind", "value"], "left_anti")
    found = match_values(todo, terms).unionByName(names.select("kind", "value", F.col("own_id").alias("term_id"), F.lit(0).alias("distance")))
    return long.join(found, ["kind", "value"]).select("label_id", "field", "kind", "value", "term_id", "distance")
