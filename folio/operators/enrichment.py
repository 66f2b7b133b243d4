"""Tiered metadata enrichment (J1-J3, P9, P10, P20; job X4).

The reference asks a remote service per record.  Here the metadata is a table
(a bulk dump or previously collected responses) and the lookup is two
equi-joins:

* tier 1 joins on the cleaned ISBN;
* tier 2 joins on the normalised title (optionally title + author) and runs
  only on the records tier 1 did not match.

The metadata is parsed once into a stage table; each lookup side is reduced
from it to one row per key (lowest order key wins, like "first search
result"), so the joins never multiply rows.  The records flow through one
linear chain (ISBN join, then title join), read once.  A record
without an ISBN, or already matched by ISBN, joins with a unique key that
never matches, so such records spread over all partitions instead of piling
up under a NULL key.  A popular title on the record side is a skewed join
key; the lookup side holds one row per key, so adaptive execution can split
that partition (``spark.sql.adaptive.skewJoin.enabled``) at the cost of
re-reading a single lookup row, a lookup side that turns out small is
broadcast at run time, and ``skew_salt`` salts the title join explicitly.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folio.constants import (
    ISBN_IDENTIFIER_TYPES,
    META_SCHEMA_DDL,
    STATUS_FOUND,
    STATUS_MISSING,
)
from folio.functions import book_key, clean_whitespace, normalize_text
from folio.operators.cleaning import keep_first
from folio.session import reliable_checkpoint

META_FIELDS = ["title", "authors", "isbn", "year", "subjects", "summary", "publisher"]


def parse_metadata(df: DataFrame, json_col: str = "info_json", out: str = "info") -> DataFrame:
    """Parse metadata JSON text into a typed struct column."""
    return df.withColumn(out, F.from_json(F.col(json_col), META_SCHEMA_DDL))


def first_isbn(identifiers: Column) -> Column:
    """P10: identifier of the first array element typed ISBN_13 or ISBN_10."""
    matches = F.filter(identifiers, lambda x: x["type"].isin(*ISBN_IDENTIFIER_TYPES))
    return F.get(matches, 0)["identifier"]


def extract_metadata(df: DataFrame, info: str = "info", prefix: str = "meta_") -> DataFrame:
    """Flatten a metadata struct into the seven enriched fields.

    ``title`` and ``summary`` get whitespace cleaning (P4); lists stay arrays.
    """
    s = F.col(info)
    return df.withColumns(
        {
            f"{prefix}title": clean_whitespace(s["title"]),
            f"{prefix}authors": s["authors"],
            f"{prefix}isbn": first_isbn(s["industryIdentifiers"]),
            f"{prefix}year": s["publishedDate"],
            f"{prefix}subjects": s["categories"],
            f"{prefix}summary": clean_whitespace(s["description"]),
            f"{prefix}publisher": s["publisher"],
        }
    )


def remaining(df: DataFrame, done: DataFrame, key: str = "book_key") -> DataFrame:
    """Rows whose key is not in ``done`` (resume anti-join).

    Only the key column of ``done`` is read; Spark broadcasts it when its
    measured size is under the broadcast threshold and sort-merges otherwise.
    """
    return df.join(done.select(key).where(F.col(key).isNotNull()), on=key, how="left_anti")


def _meta_facts(meta: DataFrame, json_col: str) -> DataFrame:
    parsed = parse_metadata(meta, json_col)
    return extract_metadata(parsed).drop("info", json_col)


def _shape(df: DataFrame, meta_col: str, tier: Column, carry: list[str]) -> DataFrame:
    """P20: FOUND rows take the metadata fields, MISSING rows keep their own."""
    m = F.col(meta_col)
    found = m.isNotNull()
    return df.select(
        *carry,
        "record_id",
        "book_key",
        F.when(found, F.lit(STATUS_FOUND)).otherwise(F.lit(STATUS_MISSING)).alias("status"),
        "accession_no",
        "class_no_book_no",
        "pages",
        F.when(found, m["title"]).otherwise(F.col("title")).alias("title"),
        F.when(found, m["authors"]).alias("authors"),
        F.when(found, m["isbn"]).otherwise(F.col("isbn")).alias("isbn"),
        F.when(found, m["year"]).alias("year"),
        F.when(found, m["subjects"]).alias("subjects"),
        F.when(found, m["summary"]).alias("summary"),
        F.when(found, m["publisher"]).alias("publisher"),
        F.when(found, tier).alias("match_tier"),
    )


# Prefix of keys that never match a lookup key: rows that must not match a
# tier (no ISBN, or already matched) get this plus their record id, so they
# spread over all partitions instead of forming one NULL-key group.
NO_MATCH = "\u0000"
AUTHOR_SEP = "\u0001"


@dataclass
class MetadataLookup:
    """The metadata table, parsed once, reduced to one row per lookup key.

    ``facts`` holds the parsed fields of every document with its keys.  Each
    lookup is a direct keep-first of it by its own key; the author lookup is
    built only where it is asked for.  :meth:`materialize` writes the reduced
    lookups to the checkpoint folder, so many record batches (the incremental
    job) share them.
    """

    facts: DataFrame
    written: dict | None = None

    def _first(self, name: str, rows: DataFrame, key: str, out: str) -> DataFrame:
        if self.written is not None and name in self.written:
            return self.written[name]
        first = keep_first(rows.where(F.col(key).isNotNull()).select(key, "_order", "_m"), [key], ["_order"])
        return first.select(F.col(key).alias(out), F.col("_m").alias("_i" if name == "isbn" else "_m2"))

    @property
    def by_isbn(self) -> DataFrame:
        return self._first("isbn", self.facts, "_isbn", "_ik")

    @property
    def by_title(self) -> DataFrame:
        return self._first("title", self.facts, "_title", "_tk")

    @property
    def by_title_author(self) -> DataFrame:
        authors = self.facts.select("_order", "_m", "_title", F.explode("_m.authors").alias("_a"))
        keyed = authors.withColumn("_key", F.concat(F.col("_title"), F.lit(AUTHOR_SEP), normalize_text("_a")))
        return self._first("title_author", keyed, "_key", "_tk")

    def materialize(self, use_author: bool = False) -> "MetadataLookup":
        names = ["isbn", "title", *(["title_author"] if use_author else [])]
        written = {n: reliable_checkpoint(getattr(self, f"by_{n}"), f"lookup-{n}") for n in names}
        return MetadataLookup(self.facts, written)


def build_lookup(
    meta: DataFrame,
    json_col: str = "info_json",
    isbn_key: str = "isbn_key",
    title_key: str = "title_key",
    order: str = "meta_pos",
) -> MetadataLookup:
    """Parse the metadata documents once, into a stage table that the lookups
    (lowest ``order`` per ISBN key, per title key, and per title key and
    normalised author) are reduced from."""
    facts = _meta_facts(meta, json_col).select(
        F.col(order).alias("_order"),
        F.col(isbn_key).cast("string").alias("_isbn"),
        F.col(title_key).cast("string").alias("_title"),
        F.struct(*[F.col(f"meta_{f}").alias(f) for f in META_FIELDS]).alias("_m"),
    )
    return MetadataLookup(reliable_checkpoint(facts, "metadata-facts"))


def enrich(
    records: DataFrame,
    meta: DataFrame | MetadataLookup,
    json_col: str = "info_json",
    isbn_key: str = "isbn_key",
    title_key: str = "title_key",
    order: str = "meta_pos",
    use_author: bool = False,
    carry: tuple[str, ...] = (),
    skew_salt: int = 0,
) -> DataFrame:
    """Two-tier lookup of clean records against a metadata table.

    ``records`` needs record_id, title, isbn, accession_no, class_no_book_no,
    pages (and author_editor when ``use_author``).  ``meta`` is the metadata
    table (pre-normalised keys, an order column, the JSON document) or a
    prepared :class:`MetadataLookup`.  The output has the enriched columns
    plus ``match_tier`` ('isbn', 'title', 'title_author' or NULL).

    ``carry`` names extra record columns to keep (e.g. an order key).

    ``use_author=True`` makes tier 2 match title and author (any listed
    author, normalised) for records that have an author; records without one
    match on the title alone.

    Plan: one linear chain, records -> left join ISBN lookup -> left join
    title lookup -> shape; the records are read once.  A record without an
    ISBN, or already matched by ISBN, joins with a unique never-matching key
    instead of NULL, so no partition collects all of them.

    ``skew_salt=S`` (S > 1) salts the title join: records are spread over S
    sub-keys by a hash of their record id and the one-row-per-key side is
    copied S times, so one title holding a large share of the records is
    split over S tasks even where adaptive skew handling is off.  The default
    (0) relies on adaptive execution, which splits only partitions measured
    as skewed and copies nothing otherwise.
    """
    carry = list(carry)
    # Written lookups: both sides of each join are then plain shuffles, which
    # is what adaptive execution can split (an aggregate below the join, with
    # its partitioning reused, would take that away).
    lookup = (meta if isinstance(meta, MetadataLookup)
              else build_lookup(meta, json_col, isbn_key, title_key, order).materialize(use_author))
    by_isbn = lookup.by_isbn
    title_side = lookup.by_title.withColumn("_tier2", F.lit("title"))
    if use_author:
        title_side = title_side.unionByName(lookup.by_title_author.withColumn("_tier2", F.lit("title_author")))

    never = F.concat(F.lit(NO_MATCH), F.coalesce(F.col("record_id").cast("string"), F.lit("")))
    base = records.withColumn("book_key", book_key()).withColumn("_k1", F.coalesce(F.col("isbn"), never))
    tier1 = base.join(by_isbn, F.col("_k1") == F.col("_ik"), "left")

    title_key_expr = F.coalesce(F.col("title"), never)
    if use_author:
        title_key_expr = F.when(
            F.col("author_editor").isNotNull(),
            F.concat(title_key_expr, F.lit(AUTHOR_SEP), F.col("author_editor")),
        ).otherwise(title_key_expr)
    k2 = F.when(F.col("_i").isNotNull(), never).otherwise(title_key_expr)
    tier2 = _title_join(tier1.withColumn("_k2", k2), title_side, skew_salt)

    tier = F.when(F.col("_i").isNotNull(), F.lit("isbn")).otherwise(F.col("_tier2"))
    return _shape(tier2.withColumn("_m", F.coalesce("_i", "_m2")), "_m", tier, carry)


def _title_join(records: DataFrame, side: DataFrame, salt: int) -> DataFrame:
    """Left join on ``_k2 = _tk`` against the one-row-per-key title side,
    optionally salted."""
    if salt <= 1:
        return records.join(side, F.col("_k2") == F.col("_tk"), "left")
    salted = records.withColumn("_salt", F.pmod(F.xxhash64("record_id"), F.lit(salt)))
    copies = side.withColumn("_salt2", F.explode(F.sequence(F.lit(0), F.lit(salt - 1))))
    joined = salted.join(
        copies, (F.col("_k2") == F.col("_tk")) & (F.col("_salt") == F.col("_salt2")), "left"
    )
    return joined.drop("_salt", "_salt2")
