"""Benchmark decontamination by template canonicalisation (DataFrame functions
only).

Method
  1. Every whole text becomes tokens, in two views.  In the *template* view
     numbers, units after a number, and names are typed slots: the token keeps
     its value behind a type mark, its canonical form is the mark alone.  A
     name is a capitalised word anywhere, also at the start of a sentence,
     but for common words that sentences start with (``STARTERS``); words of a
     name that follow each other are one slot, so "Anna" and "Mary Jane" align.
     In the *plain* view all tokens are lower-cased words and numbers: copies
     in any case, and items that are mostly slots, are found there.
  2. Benchmark items and documents are cut into windows of ``size`` canonical
     tokens (an item of ``least`` to size - 1 tokens is one window of its own
     length).  Template windows with fewer than ``least`` literal tokens say
     nothing and are left out; plain windows are all kept.  The windows are
     joined on their 64-bit hash, the canonical tokens are compared afterwards.
  3. Matches are grouped by document, item, view and alignment.  Slots must be
     filled consistently: along one alignment equal slot values of the item
     meet equal values of the document and different ones different values.
     A template alignment with ``windows`` matches (or all of a shorter item)
     counts as the item, verbatim or with other parameters; a plain one counts
     if all windows of the item match, that is, if the whole item is there.

Not found: items re-worded outside their slots, and re-parameterised ones all of
whose windows are mostly slots ("What is 12 + 45?" with other numbers).

Item windows are broadcast only if their count is within ``BROADCAST_ROWS``;
beyond that the join shuffles.

Defined results: null texts have no tokens and match nothing; items of fewer
than ``least`` tokens are never matched; repeated rows and repeated ids give
one row per (doc_id, item_id); a missing id is a value like any other; extra
columns are ignored; empty tables give no match.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.llm.common import Stages, broadcast_if_small

SIZE = 8
LEAST = 5
WINDOWS = 6
BROADCAST_ROWS = 1_000_000
BROADCAST_DOCS = 1_000_000

# Unit words and signs that form a slot after a number.
UNITS = (
    "%", "percent", "mm", "cm", "m", "km", "meter", "meters", "metre", "metres", "mile", "miles", "inch", "inches", "foot", "feet",
    "g", "kg", "mg", "gram", "grams", "pound", "pounds", "lb", "lbs", "ton", "tons", "l", "ml", "liter", "liters", "litre", "litres",
    "s", "ms", "second", "seconds", "minute", "minutes", "hour", "hours", "day", "days", "week", "weeks", "month", "months",
    "year", "years", "dollar", "dollars", "euro", "euros", "cent", "cents", "degree", "degrees",
)
# Words that often start a sentence and are no names.
STARTERS = (
    "A", "After", "All", "Also", "Although", "An", "And", "Any", "Are", "As", "At", "Because", "Before", "But", "By", "Calculate",
    "Can", "Choose", "Compute", "Consider", "Could", "Describe", "Determine", "Did", "Do", "Does", "During", "Each", "Every", "Explain",
    "Find", "For", "From", "Given", "Has", "Have", "He", "Her", "Here", "His", "How", "However", "I", "If", "In", "Is", "It", "Its", "Let",
    "Many", "Most", "My", "No", "Not", "Now", "Of", "On", "Once", "One", "Or", "Our", "Select", "She", "Should", "Since", "So", "Some",
    "Solve", "Suppose", "That", "The", "Their", "Then", "There", "These", "They", "This", "Those", "To", "Two", "Under", "Until", "Was",
    "We", "Were", "What", "When", "Where", "Which", "While", "Who", "Whose", "Why", "Will", "With", "Would", "Write", "You", "Your",
)
NAME, NUMBER, UNIT, POINT = "\x01", "\x02", "\x03", "\x04"
#: Between the words of one name.
JOIN = "\x05"
TEMPLATE_VIEW, PLAIN_VIEW = 0, 1


def _numbers(text: Column) -> Column:
    """The text with marks before numbers and units."""
    units = "|".join(sorted(UNITS, key=len, reverse=True))
    t = F.regexp_replace(text, "(?<=[0-9])[.,](?=[0-9])", POINT)
    t = F.regexp_replace(t, f"([0-9][0-9{POINT}]*)", f" {NUMBER}$1 ")
    t = F.regexp_replace(t, f"({NUMBER}[0-9{POINT}]+ ) ?(?i:({units}))(?![\\p{{L}}0-9])", f"$1{UNIT}$2 ")
    return F.when(text.rlike("[0-9]"), t).otherwise(text)


def _names(marked: Column) -> Column:
    """A marked text with marks before names.  Every pattern starts with a test
    of one character, which fails fast at nearly all places."""
    starter = f"(?:{'|'.join(STARTERS)})(?!\\p{{L}})"
    t = F.regexp_replace(marked, f"(?=\\p{{Lu}})(?!(?<!\\p{{L}}){starter})(\\p{{Lu}}\\p{{L}}*) (?=\\p{{Lu}})(?!{starter})", f"$1{JOIN}")
    t = F.regexp_replace(t, f"(?=\\p{{Lu}})(?<![\\p{{L}}{JOIN}{UNIT}])([\\p{{L}}{JOIN}]+)", f"{NAME}$1")
    return F.regexp_replace(t, f"{NAME}((?:{'|'.join(STARTERS)})(?![\\p{{L}}{JOIN}]))", "$1")


def _split(text: Column) -> Column:
    parts = F.split(F.lower(text), f"[^\\p{{L}}0-9%{NAME}{NUMBER}{UNIT}{POINT}{JOIN}]+")
    return F.array_remove(F.coalesce(parts, F.array().cast("array<string>")), "")


def _views(rows: DataFrame, *keep: str) -> DataFrame:
    """view and toks of every row with a ``text``, beside the columns kept.
    Slots are mark + value in the template view."""
    marked = rows.withColumn("__marked", _numbers(F.col("text")))
    both = F.array(_split(_names(F.col("__marked"))), _split(F.translate(F.col("__marked"), NUMBER + UNIT, "")))
    return marked.select(*keep, F.posexplode(both).alias("view", "toks"))


def canonical(tokens: Column) -> Column:
    return F.transform(tokens, lambda x: F.when(x < POINT, F.substring(x, 1, 1)).otherwise(x))


def _with_hashes(rows: DataFrame, canon: Column, widths: list[int]) -> DataFrame:
    """``rows`` with an array column h<width> for every width: a hash of every
    ``width`` consecutive tokens (empty if there are fewer).  A token is hashed
    once; longer spans are put together from two shorter ones.  Each span is a
    column of its own, so that none is computed twice."""
    rows = rows.withColumn("h1", F.transform(canon, lambda x: F.xxhash64(x)))
    done = {1}

    def add(k: int) -> None:
        nonlocal rows
        if k in done:
            return
        head = 1 << (k - 1).bit_length() - 1  # the largest power of two below k
        add(head)
        add(k - head)
        n = F.greatest(F.lit(0), F.size("h1") - (k - 1))
        rows = rows.withColumn(f"h{k}", F.zip_with(F.slice(f"h{head}", F.lit(1), n), F.slice(f"h{k - head}", F.lit(head + 1), n), lambda x, y: F.xxhash64(x, y)))
        done.add(k)

    for w in widths:
        add(w)
    return rows


def _literals(canon: Column) -> Column:
    return F.size(F.filter(canon, lambda x: x >= POINT))


def item_windows(items: DataFrame, size: int, least: int) -> DataFrame:
    """item_id, item_key, view, width, ipos, itoks, icanon, h."""
    items = items.select("item_id", F.xxhash64("text").alias("item_key"), F.col("text").cast("string").alias("text"))
    toks = _views(items, "item_id", "item_key").filter(F.size("toks") >= least)
    toks = toks.withColumn("width", F.least(F.lit(size), F.size("toks")))
    cut = toks.select("item_id", "item_key", "view", "width", "toks", F.explode(F.sequence(F.lit(1), F.size("toks") - F.col("width") + 1)).alias("ipos"))
    cut = cut.select("item_id", "item_key", "view", "width", "ipos", F.slice("toks", F.col("ipos"), F.col("width")).alias("itoks"))
    cut = cut.withColumn("icanon", canonical(F.col("itoks"))).filter((F.col("view") == PLAIN_VIEW) | (_literals(F.col("icanon")) >= least))
    widths = list(range(min(least, size), size + 1))
    cut = _with_hashes(cut, F.col("icanon"), widths)
    h = F.coalesce(*(F.when(F.col("width") == w, F.get(f"h{w}", F.lit(0))) for w in widths))
    return cut.select("item_id", "item_key", "view", "width", "ipos", "itoks", "icanon", h.alias("h"))


def matched_windows(docs: DataFrame, items: DataFrame, size: int = SIZE, least: int = LEAST) -> DataFrame:
    """Aligned window matches: doc_id, doc_key, view, pos, toks (of the document),
    item_id, item_key, ipos, itoks, n_windows (of the item in that view)."""
    st = Stages(docs.sparkSession, "decontam")
    docs = docs.select("doc_id", F.xxhash64("text").alias("doc_key"), F.col("text").cast("string").alias("text"))
    wins = st.put(item_windows(items, size, least).distinct(), "items")
    n_wins = wins.count()
    # `width` takes at most size - least + 1 values.
    widths = sorted(r["width"] for r in wins.select("width").distinct().collect())
    small = broadcast_if_small(wins.select("h", "width", "view").distinct(), n_wins, BROADCAST_ROWS)
    widths = widths or [size]
    canon = _views(docs, "doc_id", "doc_key").select("doc_id", "doc_key", "view", canonical(F.col("toks")).alias("canon"))
    spans = _with_hashes(canon, F.col("canon"), widths)
    # One path for any number of widths: exploding an array column itself would
    # have Spark test its size below, which computes all hashes a second time.
    flat = (spans.select("doc_id", "doc_key", "view", F.explode(F.array(*[F.struct(F.lit(w).alias("width"), F.col(f"h{w}").alias("hs")) for w in widths])).alias("w"))
            .select("doc_id", "doc_key", "view", "w.width", F.posexplode("w.hs").alias("p", "h")))
    hits = st.put(flat.join(small, ["h", "width", "view"], "left_semi").select("doc_id", "doc_key", "view", (F.col("p") + 1).alias("pos"), "h", "width"), "hits")
    keys = st.put(hits.select(F.col("doc_id").alias("d"), F.col("doc_key").alias("k")).distinct(), "keys")
    keys = broadcast_if_small(keys, keys.count(), BROADCAST_DOCS)
    found = docs.join(keys, docs["doc_id"].eqNullSafe(F.col("d")) & (docs["doc_key"] == F.col("k")), "left_semi").dropDuplicates(["doc_id", "doc_key"])
    full = _views(found, "doc_id", "doc_key").select(F.col("doc_id").alias("d"), F.col("doc_key").alias("k"), F.col("view").alias("v"), F.col("toks").alias("all"))
    at = hits.distinct().groupBy("doc_id", "doc_key", "view").agg(F.collect_list(F.struct("pos", "h", "width")).alias("at"))
    spots = (at.join(full, at["doc_id"].eqNullSafe(full["d"]) & (at["doc_key"] == full["k"]) & (at["view"] == full["v"]))
             .select("doc_id", "doc_key", "view", F.transform("at", lambda a: F.struct(
                 a["pos"].alias("pos"), a["h"].alias("h"), F.slice("all", a["pos"], a["width"]).alias("toks"))).alias("at"))
             .select("doc_id", "doc_key", "view", F.explode("at").alias("a")).select("doc_id", "doc_key", "view", "a.*"))
    count = (wins.groupBy(F.col("item_id").alias("c_id"), F.col("item_key").alias("c_key"), F.col("view").alias("c_view"))
             .agg(F.count("*").alias("n_windows")))
    same = F.col("item_id").eqNullSafe(F.col("c_id")) & (F.col("item_key") == F.col("c_key")) & (F.col("view") == F.col("c_view"))
    sized = st.put(wins.join(count, same).select("item_id", "item_key", "view", "ipos", "h", "itoks", "icanon", "n_windows"), "sized")
    return (spots.join(broadcast_if_small(sized, n_wins, BROADCAST_ROWS), ["h", "view"])
            .filter(canonical(F.col("toks")) == F.col("icanon")).drop("icanon", "h"))


def contaminated(docs: DataFrame, items: DataFrame, size: int = SIZE, least: int = LEAST, windows: int = WINDOWS) -> DataFrame:
    """One row per (doc_id, item_id) that is found: ``n_windows`` matched
    along the best alignment, and ``verbatim`` (false: all alignments fill a
    slot with another value)."""
    return found_lines(docs, items, size, least, windows).groupBy("doc_id", "item_id").agg(
        F.max("found").alias("n_windows"),
        F.max(F.forall("pairs", lambda p: p["i"] == p["d"])).alias("verbatim"))


def found_lines(docs: DataFrame, items: DataFrame, size: int = SIZE, least: int = LEAST, windows: int = WINDOWS) -> DataFrame:
    """doc_id, doc_key, item_id, found, pairs of every alignment that counts."""
    hit = matched_windows(docs, items, size, least)
    pair = F.struct("i", "d")
    slots = F.filter(F.zip_with("itoks", "toks", lambda a, b: F.struct(a.alias("i"), b.alias("d"))), lambda s: s["i"] < POINT)
    lines = (hit.withColumn("slots", slots)
             .groupBy("doc_id", "doc_key", "item_id", "item_key", "view", (F.col("pos") - F.col("ipos")).alias("shift"))
             .agg(F.countDistinct("ipos").alias("found"), F.max("n_windows").alias("n_windows"),
                  F.array_distinct(F.flatten(F.collect_set("slots"))).alias("pairs")))
    one_to_one = ((F.size("pairs") == F.size(F.array_distinct(F.transform("pairs", lambda p: p["i"]))))
                  & (F.size("pairs") == F.size(F.array_distinct(F.transform("pairs", lambda p: p["d"])))))
    enough = F.when(F.col("view") == PLAIN_VIEW, F.col("n_windows")).otherwise(F.least(F.lit(windows), F.col("n_windows")))
    return lines.filter(one_to_one & (F.col("found") >= enough))


def decontaminate(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` in which no item is found.  A row goes for its own
    text (doc_id and hash of the text), not for another row's with its id."""
    st = Stages(docs.sparkSession, "decontam")
    bad = st.put(found_lines(docs, items, **options).select(F.col("doc_id").alias("__bad"), F.col("doc_key").alias("__key")).distinct(), "bad")
    few = broadcast_if_small(bad, bad.count(), BROADCAST_DOCS)
    return docs.join(few, docs["doc_id"].eqNullSafe(F.col("__bad")) & (F.xxhash64(docs["text"]) == F.col("__key")), "left_anti")


def oracle_sql(size: int = SIZE, least: int = LEAST, windows: int = WINDOWS) -> str:
    """DuckDB SQL for ``contaminated`` over the given tables."""
    units = "|".join(sorted(UNITS, key=len, reverse=True))
    starters = "|".join(STARTERS)

    # No look-around: where neighbours share a character, two passes.
    def marked(c: str) -> str:
        t = c
        for _ in range(2):
            t = rf"regexp_replace({t}, '([0-9])[.,]([0-9])', '\1' || chr(4) || '\2', 'g')"
        t = rf"regexp_replace({t}, '([0-9][0-9\x04]*)', ' ' || chr(2) || '\1 ', 'g')"
        return rf"regexp_replace({t}, '(\x02[0-9\x04]+ ) ?((?i:{units}))([^\p{{L}}0-9]|$)', '\1' || chr(3) || '\2 \3', 'g')"

    def names(c: str) -> str:
        t = c
        for _ in range(2):
            t = rf"regexp_replace({t}, '(^|[^\p{{L}}\x06])({starters})([^\p{{L}}\x06]|$)', '\1' || chr(6) || '\2' || chr(6) || '\3', 'g')"
        for _ in range(2):
            t = rf"regexp_replace({t}, '(\p{{Lu}}\p{{L}}*) (\p{{Lu}})', '\1' || chr(5) || '\2', 'g')"
        return rf"regexp_replace({t}, '(^|[^\p{{L}}\x03\x05\x06])(\p{{Lu}}[\p{{L}}\x05]*)', '\1' || chr(1) || '\2', 'g')"

    def toks(c: str) -> str:
        return rf"list_filter(string_split_regex(lower(coalesce({c}, '')), '[^\p{{L}}0-9%\x01\x02\x03\x04\x05]+'), lambda x: x <> '')"

    template, plain = toks(names("marked")), toks("translate(marked, chr(2) || chr(3), '')")

    def views(table: str, keep: str) -> str:
        return (f"SELECT {keep}, {TEMPLATE_VIEW} AS view, {template} AS toks FROM {table} UNION ALL "
                f"SELECT {keep}, {PLAIN_VIEW} AS view, {plain} AS toks FROM {table}")

    canon = "list_transform({0}, lambda x: CASE WHEN x < chr(4) THEN x[1] ELSE x END)"
    return f"""
WITH im AS (SELECT DISTINCT item_id, text AS item_key, {marked('text')} AS marked FROM benchmark),
it AS ({views('im', 'item_id, item_key')}),
iw AS (SELECT *, least({size}, len(toks)) AS width FROM it WHERE len(toks) >= {least}),
ix AS (SELECT item_id, item_key, view, width, ipos, toks[ipos:ipos + width - 1] AS itoks
       FROM (SELECT *, unnest(range(1, len(toks) - width + 2)) AS ipos FROM iw)),
iy AS (SELECT *, {canon.format('itoks')} AS canon FROM ix),
items AS (SELECT *, count(*) OVER (PARTITION BY item_id, item_key, view) AS n_items FROM iy
          WHERE view = {PLAIN_VIEW} OR len(list_filter(canon, lambda x: x >= chr(4))) >= {least}),
dm AS (SELECT DISTINCT doc_id, text AS doc_key, {marked('text')} AS marked FROM documents),
d AS ({views('dm', 'doc_id, doc_key')}),
dc AS (SELECT *, {canon.format('toks')} AS canon FROM d),
dx AS (SELECT doc_id, doc_key, view, pos, width, canon[pos:pos + width - 1] AS canon, toks[pos:pos + width - 1] AS toks
       FROM (SELECT *, unnest(range(1, len(canon) - width + 2)) AS pos
             FROM dc, (SELECT DISTINCT width FROM items) WHERE len(canon) >= width)),
hit AS (SELECT doc_id, doc_key, item_id, item_key, view, pos - ipos AS shift, ipos, n_items,
               list_filter(list_transform(list_zip(itoks, toks), lambda z: {{'i': z[1], 'd': z[2]}}), lambda s: s.i < chr(4)) AS slots
        FROM dx JOIN items USING (canon, width, view)),
line AS (SELECT doc_id, doc_key, item_id, item_key, view, shift, count(DISTINCT ipos) AS found, max(n_items) AS n_items,
                list_distinct(flatten(list(slots))) AS pairs
         FROM hit GROUP BY ALL)
SELECT doc_id, item_id, max(found) AS n_windows,
       bool_or(len(list_filter(pairs, lambda p: p.i <> p.d)) = 0) AS verbatim
FROM line
WHERE len(pairs) = len(list_distinct(list_transform(pairs, lambda p: p.i)))
  AND len(pairs) = len(list_distinct(list_transform(pairs, lambda p: p.d)))
  AND found >= CASE WHEN view = {PLAIN_VIEW} THEN n_items ELSE least({windows}, n_items) END
GROUP BY doc_id, item_id
"""
