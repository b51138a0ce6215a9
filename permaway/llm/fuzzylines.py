"""Fuzzy line dedup: MinHash over character shingles, exact check, union-find. DataFrame functions only."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from permaway.llm.rows import KEY, each_text, join_found, join_rows, text_keys
from permaway.operators.components import connected_components
from permaway.operators.scratch import cut_clean as cut
from permaway.operators.scratch import discard, hint_small, settle

#: Minima of a signature: the hashes of all shingles are dealt to so many bins by their low bits.
BINS = 32
#: An empty bin borrows from bin (a * i + b) % BINS, in each round that of the round before.
BORROW = ((13, 7), (5, 17), (29, 3), (21, 11), (9, 26), (17, 5))
#: The minima of each band, one of every eight: bands share one minimum at most. Sets that are
#: alike by 0.8 agree in a band with a probability of 0.994, by 0.85 of 0.999.
BANDS = tuple((i, 8 + i, 16 + i, 24 + i) for i in range(8)) + tuple((i, 8 + (i + 1) % 8, 16 + (i + 3) % 8, 24 + (i + 5) % 8) for i in range(4))
#: Of each minimum four bits are kept; lines of which fewer agree are not compared.
#: Of pairs of a similarity of 0.8 less than one in a thousand has so few.
AGREE = 17
#: Lines of which so many agree are taken for alike until they have been compared.
LIKELY = 24
#: Words of 64 bits with a bit for each shingle of a line: most pairs at 0.7 of lines of up to a thousand characters are told by them.
MARKS = 32
#: What is trimmed off a line's ends.
BLANKS = " \t\n\x0b\x0c\r"


def shingles(line: str, k: int) -> str:
    """SQL of the 64-bit hashes of a folded line's k-character shingles; a shorter line is its own one.

    Four bytes to a character, so that a shingle is a slice."""
    each = f"transform(sequence(1, 4 * (length({line}) - {k}) + 1, 4), i -> xxhash64(substring(b, i, {4 * k})))"
    return f"CASE WHEN length({line}) < {k} THEN array(xxhash64({line})) ELSE element_at(transform(array(encode({line}, 'UTF-32')), b -> {each}), 1) END"


def each_shingle(lines: DataFrame, k: int, *keys: str) -> DataFrame:
    """(keys, h): a row of the 64-bit hash of each k-character shingle of a line, as often as it occurs.

    Rows, since they are hashed in generated code. Four bytes to a character, so that a
    shingle is a slice; a shorter line is its own one."""
    # A lambda ends the generated function of the scan here, which would be too long to be compiled.
    x = lines.select(*keys, F.expr("element_at(transform(array(line), x -> encode(x, 'UTF-32')), 1)").alias("b"))
    x = x.select(*keys, "b", F.expr(f"explode(sequence(1, greatest(length(b) - {4 * k - 1}, 1), 4))").alias("i"))
    return x.select(*keys, F.expr(f"xxhash64(substring(b, i, {4 * k}))").alias("h"))


def signatures(lines: DataFrame, k: int) -> DataFrame:
    """(h1, h2, n, bands, s1, s2) of each line that differs from the others: MinHash over all
    k-character shingles, by one permutation.

    Shingles are rows, hashed in generated code, and the minima ordinary aggregates that are
    combined before the shuffle; equal lines fall together. Each shingle counts in the one bin
    that its hash names, whose filter spares the others. A bin that no shingle of a short line
    falls into borrows along a fixed order of bins, so that two lines agree in a bin with the
    probability of their similarity there too.
    """
    x = each_shingle(lines, k, "h1", "h2", "n").select("h1", "h2", "n", F.expr("cast(shiftright(h, 32) as int)").alias("s"))
    g = x.groupBy("h1", "h2", "n").agg(*[F.expr(f"min(s) FILTER (WHERE (s & {BINS - 1}) = {i})").alias(f"m{i}") for i in range(BINS)])
    full = F.expr(" ^ ".join(f"m{i}" for i in range(BINS)) + " is not null")
    # Of lines that fill all bins, nearly all, bands and sketches are generated code; lambdas, which
    # are not, have the lines that borrow, and keep minima from being put in place of their names.
    m = F.array(*[f"m{i}" for i in range(BINS)])
    g = g.select("h1", "h2", "n", full.alias("full"), F.when(~full, m).alias("m"), *[f"m{i}" for i in range(BINS)])
    g = g.select("*", F.expr(f"CASE WHEN NOT full THEN {_borrowed('m')} END").alias("lent"))

    def either(direct: str, lent: str) -> Column:
        return F.expr(f"CASE WHEN full THEN {direct} ELSE element_at(transform(array(lent), m -> {lent}), 1) END")

    # Forty bits of a band's hash: fewer bytes as a table, and lines that meet by chance are compared like others.
    bands = lambda x: ", ".join(f"xxhash64({b}, {', '.join(x.format(i) for i in members)}) & 1099511627775L" for b, members in enumerate(BANDS))
    sketch = lambda x, half: " | ".join(f"shiftleft(cast(shiftright({x.format(half + i)}, 5) & 15 as bigint), {60 - 4 * i})" for i in range(16))
    both = [(f"array({bands('m{}')})", f"array({bands('m[{}]')})"), *[(sketch("m{}", half), sketch("m[{}]", half)) for half in (0, 16)]]
    return g.select("h1", "h2", "n", *[either(*x).alias(c) for c, x in zip(("bands", "s1", "s2"), both, strict=True)])


def _borrowed(m: str) -> str:
    """SQL of the minima m with a value in every bin. Most lines are done after two rounds or three."""
    out = m
    for r, (a, b) in enumerate(BORROW):
        lent = f"transform(m{r}, (x, i) -> coalesce(x, m{r}[(i * {a} + {b}) & {BINS - 1}]))"
        out = f"element_at(transform(array({out}), m{r} -> IF(exists(m{r}, x -> x is null), {lent}, m{r})), 1)"
    return f"transform({out}, x -> coalesce(x, array_min({m})))"


def trimmed(line: str) -> Column:
    """The line less BLANKS at its ends. To trim walks through all of a line, so it is left out for most."""
    ends = [getattr(F.col(line), at)(c) for c in BLANKS for at in ("startswith", "endswith")]
    return F.when(reduce(or_, ends), F.btrim(line, F.lit(BLANKS))).otherwise(F.col(line))


def lines_of(docs: DataFrame) -> DataFrame:
    """(doc_id, r1, r2, pos, h1, h2, n, line) of the lines that hold something: lower case, ASCII
    blanks at the ends off. 96 bits of two hashes and the length stand for a line."""
    # The text's own hashes come before its lines, once a text. Not the plain posexplode, for which Spark splits once more in a filter.
    u = docs.select("doc_id", *text_keys(F.col("text")), F.split(F.lower("text"), "\n", -1).alias("lines"))
    u = u.select(*KEY, F.posexplode_outer("lines").alias("pos", "line"))
    u = u.withColumn("line", trimmed("line")).where("line <> ''")
    return u.select(*KEY, "pos", F.xxhash64("line").alias("h1"), F.hash("line").alias("h2"), F.length("line").alias("n"), "line")


def places_of(docs: DataFrame) -> DataFrame:
    """(doc_id, r1, r2, pos, line) of all lines as they stand. A line folds alike by itself and within
    its text, since what a letter becomes depends on nothing beyond a line feed."""
    u = docs.select("doc_id", *text_keys(F.col("text")), F.split("text", "\n", -1).alias("lines"))
    return u.select(*KEY, F.posexplode_outer("lines").alias("pos", "line"))


def _agreeing(x: str, y: str) -> str:
    """SQL of how many of the minima's low four bits two sketches share."""
    parts = []
    for s in ("s1", "s2"):
        d = f"({x}{s} ^ {y}{s})"
        parts.append(f"bit_count((({d} | shiftrightunsigned({d}, 1) | shiftrightunsigned({d}, 2) | shiftrightunsigned({d}, 3)) & 1229782938247303441L))")
    return f"{BINS} - {' - '.join(parts)}"


def members_of(distinct: DataFrame) -> DataFrame:
    """(band, id, s1, s2): the lines in each bucket of two or more."""
    b = distinct.select("id", "s1", "s2", F.explode("bands").alias("band"))
    met = cut(b.groupBy("band").agg(F.count("*").alias("c")).where("c > 1").select("band"))
    return cut(join_found(b, met, ["band"], "band").select("band", "id", "s1", "s2"))


def leader_pairs(members: DataFrame) -> DataFrame:
    """(id, oid, agree): every line and the leaders of its buckets, those of the smallest id and
    of the smallest hash of id and band: aggregates combined before the shuffle, joined back so
    that the lines of a hot bucket are spread over tasks. `left_links` has the others."""
    row = F.struct("id", "s1", "s2")
    g = members.groupBy("band").agg(F.min(row).alias("one"), F.min(F.struct(F.xxhash64("id", "band").alias("h"), "id", "s1", "s2")).alias("two"))
    leaders = cut(g.select("band", F.explode(F.array("one", F.struct("two.id", "two.s1", "two.s2"))).alias("o")).select("band", F.col("o.id").alias("oid"), F.col("o.s1").alias("os1"), F.col("o.s2").alias("os2")).distinct())
    j = members.join(leaders, "band").where("id <> oid").withColumn("agree", F.expr(_agreeing("", "o"))).where(f"agree >= {AGREE}")
    return j.select("id", "oid", "agree").distinct()


def leader_groups(places: DataFrame, distinct: DataFrame, members: DataFrame, threshold: float, k: int) -> DataFrame:
    """(node, component) of the lines that resemble leaders: each line is compared with one, the
    smallest of those that are LIKELY to be like it; then, of the others that are, one pair of
    any two components that came of that. What both leave over is for `left_links`."""
    pairs = cut(leader_pairs(members))
    texts = cut(texts_of(places, distinct, pairs.select(F.explode(F.array("id", "oid")).alias("id"))))
    one = pairs.groupBy("id").agg(F.min(F.struct((F.col("agree") < LIKELY).alias("far"), "oid")).alias("to"))
    links = cut(compared(one.select(F.least("id", "to.oid").alias("a"), F.greatest("id", "to.oid").alias("b")).distinct(), texts, threshold, k))
    groups = hint_small(cut(connected_components(links, "a", "b")))
    rest = pairs.where(f"agree >= {LIKELY}")
    for c in ("id", "oid"):
        rest = rest.join(groups.select(F.col("node").alias(c), F.col("component").alias("c" + c)), c, "left").withColumn("c" + c, F.coalesce("c" + c, c))
    rest = rest.where("cid <> coid").groupBy(F.least("cid", "coid").alias("x"), F.greatest("cid", "coid").alias("y"))
    rest = rest.agg(F.max(F.struct("agree", F.least("id", "oid").alias("a"), F.greatest("id", "oid").alias("b"))).alias("p")).select("p.a", "p.b")
    return connected_components(links.unionByName(compared(rest, texts, threshold, k)), "a", "b")


def mixed_buckets(members: DataFrame, groups: DataFrame) -> DataFrame:
    """members with component and major, the bucket's largest one, of buckets that hold lines of
    several components. Groups of near copies are tied by their leaders, and a bucket of one
    component is done."""
    b = cut(members.join(hint_small(groups).select(F.col("node").alias("id"), "component"), "id", "left").withColumn("component", F.coalesce("component", "id")))
    size = b.groupBy("band", "component").agg(F.count("*").alias("c"))
    major = size.groupBy("band").agg(F.max(F.struct("c", "component")).alias("x"), F.count("*").alias("kinds")).where("kinds > 1")
    return b.join(cut(major.select("band", F.col("x.component").alias("major"))), "band")


def left_links(places: DataFrame, distinct: DataFrame, members: DataFrame, groups: DataFrame, threshold: float, k: int) -> DataFrame:
    """(a, b): the links within buckets that no component holds yet.

    Lines outside a bucket's largest component are compared with all that are of another one,
    so that a very large group of copies is not compared with itself. Semi-joins on the
    sketches tell first which lines have any candidate, and only those carry their texts;
    then the marks of a pair are compared in the first band that it shares, within the join,
    which gives few but links; these are compared exactly. No list of other pairs is ever made.
    """
    mixed = settle(lambda: mixed_buckets(members, groups))
    discard(members)
    at = lambda df, x, *more: df.select("band", *more, *[F.col(c).alias(x + c) for c in ("id", "s1", "s2", "component")])
    x, y = at(mixed.where("component <> major"), "x"), at(mixed, "y", "major")
    candidate = F.expr(f"xcomponent <> ycomponent and (xid < yid or ycomponent = major) and {_agreeing('x', 'y')} >= {AGREE}")
    with_any = lambda one, other: cut(one.join(other.withColumnRenamed("band", "_band"), (F.col("band") == F.col("_band")) & candidate, "left_semi"))
    xs = with_any(x, y)
    # The candidates of a line in y are all in xs, which is small.
    ys = with_any(y, hint_small(xs))
    discard(mixed)
    refs = xs.select(F.col("xid").alias("id")).union(ys.select("yid"))
    texts = cut(texts_of(places, distinct, refs, "bands"))
    marks = cut(marks_of(texts, k).join(texts.select("id", "bands"), "id"))
    x, y = (r.join(marks.select(F.col("id").alias(n + "id"), *[F.col(c).alias(c + n) for c in ("bands", "marks", "windows")]), n + "id") for r, n in ((xs, "x"), (ys, "y")))
    first = F.col("band") == F.array_min(F.array_intersect("bandsx", "bandsy"))
    j = x.join(y.withColumnRenamed("band", "_band"), (F.col("band") == F.col("_band")) & candidate & first & F.expr(_near(threshold)))
    return compared(cut(j.select(F.col("xid").alias("a"), F.col("yid").alias("b"))), texts, threshold, k)


def marks_of(texts: DataFrame, k: int) -> DataFrame:
    """(id, marks, windows): a bit for the hash of each shingle of a line, in MARKS words, and how
    many shingles it has, repeats counted."""
    x = each_shingle(texts, k, "id").select("id", F.expr("shiftleft(1L, cast(h & 63 as int))").alias("bit"), F.expr(f"cast(shiftright(h, 6) & {MARKS - 1} as int)").alias("word"))
    g = x.groupBy("id").agg(F.count("*").alias("windows"), *[F.expr(f"bit_or(bit) FILTER (WHERE word = {w})").alias(f"w{w}") for w in range(MARKS)])
    return g.select("id", F.array(*[F.coalesce(f"w{w}", F.lit(0).cast("bigint")) for w in range(MARKS)]).alias("marks"), "windows")


def _near(threshold: float) -> str:
    """SQL of whether lines of these marks may reach the threshold; no pair that does is lost. Each
    mark of one line alone stands for another shingle of that line alone, and sets of the
    sizes a and b that are alike by t differ in (a + b) * (1 - t) / (1 + t) shingles at most."""
    apart = "aggregate(zip_with(marksx, marksy, (x, y) -> bit_count(x ^ y)), 0, (n, d) -> n + d)"
    return f"{apart} * {1 + threshold!r}D <= {1 - threshold!r}D * (windowsx + windowsy) + 0.001D"


def texts_of(places: DataFrame, distinct: DataFrame, refs: DataFrame, *more: str) -> DataFrame:
    """(id, line, more columns of distinct) of the lines of these ids, fetched by first place: no
    line but these is folded and hashed again."""
    first = [F.col(f"first.{c}").alias("_first_" + c) for c in (*KEY, "pos")]
    of = distinct.select("id", F.xxhash64(*[f"first.{c}" for c in (*KEY, "pos")]).alias("place"), *first, *more)
    at = cut(join_found(of, cut(refs.distinct()), ["id"], "xxhash64(id)"))
    here = " and ".join(f"{c} <=> _first_{c}" for c in (*KEY, "pos"))
    found = join_found(places.withColumn("place", F.xxhash64(*KEY, "pos")), at, ["place"], "place").where(here)
    return found.select("id", F.btrim(F.lower("line"), F.lit(BLANKS)).alias("line"), *more).dropDuplicates(["id"])


def _similar(x: str, y: str, threshold: float, k: int) -> str:
    """SQL of whether two lines' shingle sets reach the threshold. Bound by lambdas, so that the
    sets are made once a pair wherever the condition is pushed."""
    sets = f"transform(array(struct(array_distinct({shingles(x, k)}) as sa, array_distinct({shingles(y, k)}) as sb)), s -> struct(size(s.sa) + size(s.sb) as n, size(array_intersect(s.sa, s.sb)) as both))"
    return f"exists({sets}, s -> s.both >= {threshold}D * (s.n - s.both))"


def compared(pairs: DataFrame, texts: DataFrame, threshold: float, k: int) -> DataFrame:
    """The pairs (a, b) of which the lines in texts reach the threshold."""
    left, right = (texts.select(F.col("id").alias(x), F.col("line").alias("l" + x)) for x in "ab")
    return pairs.join(left, "a").join(right, "b").where(F.expr(_similar("la", "lb", threshold, k))).select("a", "b")


def distinct_lines(lines: DataFrame, all_lines: DataFrame, k: int) -> DataFrame:
    """(id, h1, h2, n, first, copies, bands, s1, s2): each line that differs from the others, once,
    with its first place. Both sides of the join are dealt by its keys already. To be written down
    at once, since ids come out otherwise when they are worked out again."""
    first = all_lines.groupBy("h1", "h2", "n").agg(F.min(F.struct(*KEY, "pos")).alias("first"), F.count("*").alias("copies"))
    return first.join(signatures(lines, k), ["h1", "h2", "n"]).withColumn("id", F.monotonically_increasing_id())


def line_groups(places: DataFrame, distinct: DataFrame, members: DataFrame, threshold: float, k: int) -> DataFrame:
    """(node, component) of the lines that resemble another: leaders first, then what is left. Each
    step's tables go once it is done, members too."""
    groups = settle(lambda: leader_groups(places, distinct, members, threshold, k))
    more = settle(lambda: left_links(places, distinct, members, groups, threshold, k))
    return connected_components(more.unionByName(groups.select(F.col("component").alias("a"), F.col("node").alias("b"))), "a", "b")


def gone_lines(docs: DataFrame, threshold: float = 0.8, k: int = 5) -> DataFrame:
    """(doc_id, r1, r2, gone array<int>): positions of lines whose component has an earlier line.

    Lines that are equal after folding are one line with one signature; the components
    of the distinct lines come from verified pairs; the earliest (doc_id, text's hashes,
    position) of a component stays.
    """
    all_lines = cut(lines_of(docs).drop("line"))
    distinct = settle(lambda: distinct_lines(lines_of(each_text(docs.select("doc_id", "text"))), all_lines, k))
    members = members_of(distinct)
    groups = line_groups(places_of(docs), distinct, members, threshold, k)
    # Written down, so that the join of a component's lines with its head can be split.
    at = cut(join_found(distinct.select(F.col("id").alias("node"), "first"), cut(groups), ["node"], "xxhash64(node)"))
    heads = cut(at.groupBy("component").agg(F.min("first").alias("head")))
    moved = cut(at.join(heads, "component").select(F.col("node").alias("id"), "head"))
    keep = distinct.select("id", "h1", "h2", "n", "first", "copies").join(hint_small(moved), "id", "left").withColumn("keep", F.coalesce("head", "first"))
    keep = cut(keep.where("copies > 1 or keep <> first").select("h1", "h2", "n", *[F.col(f"keep.{c}").alias("_keep_" + c) for c in (*KEY, "pos")]))
    here = " and ".join(f"{c} <=> _keep_{c}" for c in (*KEY, "pos"))
    gone = join_found(all_lines, keep, ["h1", "h2", "n"], "h1").where(f"not ({here})")
    return gone.groupBy(*KEY).agg(F.sort_array(F.collect_set("pos")).alias("gone"))


def dedup_lines_fuzzy(docs: DataFrame, threshold: float = 0.8, k: int = 5) -> DataFrame:
    """docs with text less the lines that resemble an earlier one, and n_lines, n_removed,
    removed_lines (positions) beside it, in place of columns of these names.

    Lines of nothing but ASCII blanks always stay; null and empty texts come back as they
    are. Rows of one doc_id with different texts are documents of their own, ranked by a
    hash of the text; repeated rows lose the same lines; a null doc_id is the first; an
    empty table gives none. The texts themselves are not shuffled unless the table of what
    goes is too large to be sent out.
    """
    gone = settle(lambda: gone_lines(docs.select("doc_id", "text"), threshold, k).withColumnRenamed("gone", "_gone"))
    j = join_rows(docs, hint_small(gone))
    j = j.withColumn("_gone", F.coalesce("_gone", F.expr("cast(array() as array<int>)"))).withColumn("_text", F.col("_d.text"))
    # The places that stay, by one pass of hashing, so that a text of very many lines stays linear.
    kept = F.expr(r"array_join(element_at(transform(array(split(_text, '\n', -1)), u -> transform(array_except(sequence(0, size(u) - 1), _gone), i -> u[i])), 1), '\n')")
    new = {
        "n_lines": F.coalesce(F.when(F.col("_text").isNotNull(), F.size(F.split("_text", "\n", -1))), F.lit(0)).cast("bigint"),
        "n_removed": F.size("_gone").cast("bigint"),
        "removed_lines": F.col("_gone"),
    }
    own = [F.when(F.size("_gone") > 0, kept).otherwise(F.col("_text")).alias("text") if c == "text" else F.col(f"_d.`{c}`") for c in docs.columns if c not in new]
    return j.select(*own, *[v.alias(c) for c, v in new.items()])


def op7_fuzzy_lines(spark, sf_dir: str) -> DataFrame:
    out = dedup_lines_fuzzy(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_removed", F.concat_ws(",", F.col("removed_lines").cast("array<string>")).alias("removed_lines"), F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))
