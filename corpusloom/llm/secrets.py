"""Secret scans: fixed patterns, and tokens that one owner alone holds in the whole corpus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import few, materialise

#: Fixed patterns. The keywords are matched in either case of their letters.
ASSIGN = r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: A greedy run of enough characters: the same matches as all runs, of which the short ones go.
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "owned")
ASSIGN_LEAST = 6
#: Candidates of the ownership method: long runs that mix letters and digits.
CANDIDATE = r"[A-Za-z0-9+/_-]{20,}"
CANDIDATE_DIGITS, CANDIDATE_LETTERS = 3, 3
#: A candidate that more owners hold, or two owners or more in more repositories, is a copied example: what two
#: owners have in three places at most has been moved or shared by its owner, what they have in more is passed around.
MAX_OWNERS, MAX_REPOSITORIES = 2, 3
REDACTED = "[REDACTED]"


def _let(value: Column, body) -> Column:
    """body of a value that is computed once, however often body names it, also in functions over arrays."""
    return F.transform(F.array(value), body)[0]


def running(values: Column, fold, zero: int) -> Column:
    """fold of the values up to each place, in time that grows as n times the root of n.

    The values are folded in pieces of about the root of their number, and what the pieces before
    come to is then folded into each: one long list grown value by value would be copied each time.
    """
    start = F.lit(zero).cast("int")

    def grow(parts: Column, of) -> Column:
        empty = F.struct(start.alias("at"), F.array().cast("array<int>").alias("out"))

        def step(state: Column, x: Column) -> Column:
            return _let(fold(state["at"], of(x)).cast("int"), lambda at: F.struct(at.alias("at"), F.concat(state["out"], F.array(at)).alias("out")))

        return F.aggregate(parts, empty, step, lambda s: s["out"])

    def cut(v: Column) -> Column:
        width = F.greatest(F.ceil(F.sqrt(F.size(v))).cast("int"), F.lit(1))
        pieces = _let(width, lambda w: F.transform(F.sequence(F.lit(0), F.size(v) - 1, w), lambda k: F.slice(v, k + 1, w)))
        return F.when(F.size(v) > 0, pieces).otherwise(F.array().cast("array<array<int>>"))

    def joined(parts: Column) -> Column:
        before = F.concat(F.array(start), grow(parts, lambda p: F.aggregate(p, start, lambda a, x: fold(a, x).cast("int"))))
        inside = F.transform(parts, lambda p: grow(p, lambda x: x))
        return F.flatten(F.zip_with(inside, F.slice(before, F.lit(1), F.size(parts)), lambda p, b: F.transform(p, lambda x: fold(b, x).cast("int"))))

    return _let(values, lambda v: _let(cut(v), joined))


_SPAN = "array<struct<start:int,kind:int,end:int,value:string>>"


def _matches(text: Column, pattern: str, kind: int) -> Column:
    """All matches as an array of (start, kind, end, value), in code points.

    The text between matches is what split() gives, so each match ends after the pieces and
    matches up to it.
    """

    def spans(found: Column) -> Column:
        sizes = F.zip_with(F.slice(F.split(text, pattern), F.lit(1), F.size(found)), found, lambda piece, value: F.length(piece) + F.length(value))
        return F.zip_with(running(sizes, lambda a, b: a + b, 0), found, lambda end, value: F.struct((end - F.length(value)).alias("start"), F.lit(kind).alias("kind"), end.alias("end"), value.alias("value")))

    return F.when(text.rlike(pattern), _let(F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), spans)).otherwise(F.array().cast(_SPAN))


def _outside(base: Column, tokens: Column) -> Column:
    """The tokens that no base span overlaps, by one pass over both in order of their start."""
    far = 2**31 - 1

    def free(both: Column) -> Column:
        reach = running(F.transform(both, lambda x: F.when(x["kind"] < 3, x["end"]).otherwise(0)), lambda a, b: F.greatest(a, b), 0)
        ahead = F.reverse(running(F.reverse(F.transform(both, lambda x: F.when(x["kind"] < 3, x["start"]).otherwise(far))), lambda a, b: F.least(a, b), far))
        edges = F.zip_with(reach, ahead, lambda r, a: F.struct(r.alias("reach"), a.alias("ahead")))
        seen = F.zip_with(both, edges, lambda x, e: F.when((x["kind"] == 3) & (e["reach"] <= x["start"]) & (e["ahead"] >= x["end"]), x))
        return F.filter(seen, lambda x: x.isNotNull())

    return F.when((F.size(base) > 0) & (F.size(tokens) > 0), _let(F.array_sort(F.concat(base, tokens)), free)).otherwise(tokens)


def _digits(value: Column) -> Column:
    return F.length(F.regexp_replace(value, "[^0-9]", ""))


def _letters(value: Column) -> Column:
    return F.length(F.regexp_replace(value, "[^A-Za-z]", ""))


def spans_of(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source") -> DataFrame:
    """row_id, doc_id, owner, text_hash, base (spans by start and kind) and tokens (candidates outside base spans)."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = documents.select(F.col(id_col).cast("long").alias("doc_id"), F.col(owner_col).cast("string").alias("owner"), text.alias("_text"))
    long_enough = lambda x: F.length(F.regexp_extract(x["value"], ASSIGN, 2)) >= ASSIGN_LEAST
    t = F.col("_text")
    found = rows.select("doc_id", "owner", F.xxhash64("_text").alias("text_hash"), F.filter(_matches(t, ASSIGN, 0), long_enough).alias("assign"), _matches(t, ACCESS, 1).alias("access"), _matches(t, HEX, 2).alias("hex"), _matches(t, CANDIDATE, 3).alias("_tokens"))
    found = found.withColumn("base", F.array_sort(F.concat("assign", "access", "hex"))).drop("assign", "access", "hex")
    live = lambda x: (_digits(x["value"]) >= CANDIDATE_DIGITS) & (_letters(x["value"]) >= CANDIDATE_LETTERS)
    found = found.withColumn("_live", F.filter("_tokens", live)).withColumn("row_id", F.monotonically_increasing_id())
    return found.select("row_id", "doc_id", "owner", "text_hash", "base", _outside(F.col("base"), F.col("_live")).alias("tokens"))


def _secret(x: Column) -> Column:
    """SHA-256 of what is secret in a span: of an assignment the value, of others all of it."""
    value = F.when(x["kind"] == 0, F.regexp_extract(x["value"], ASSIGN, 2)).otherwise(x["value"])
    return F.sha2(value, 256)


def ownership(found: DataFrame) -> DataFrame:
    """For each candidate and base span (SHA-256 of the secret): how many distinct owners and repositories hold it.

    An owner is a source; a repository is a distinct text of a source, so that copies count once.
    """
    spans = F.explode(F.concat("base", "tokens")).alias("x")
    held = found.select("owner", "text_hash", spans).select(_secret(F.col("x")).alias("secret"), "owner", "text_hash").distinct()
    per_owner = held.groupBy("secret", "owner").agg(F.count("*").alias("texts"))
    return per_owner.groupBy("secret").agg(F.count("*").alias("owners"), F.sum("texts").alias("repositories"))


def _render(spans: Column) -> Column:
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.element_at(kinds, x["kind"] + 1), x["start"].cast("string"), x["end"].cast("string"))), ",")


def secret_spans(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", max_owners: int = MAX_OWNERS, max_repositories: int = MAX_REPOSITORIES) -> DataFrame:
    """doc_id, owner, text_hash, base and owned: arrays of (start, kind, end, value), sorted; and n_base_owned.

    n_base_owned counts the base spans whose secret is as rare as an owned one. base holds the fixed patterns' matches. owned holds candidates outside of them that one owner
    alone holds, in however many repositories, or at most max_owners owners in at most
    max_repositories repositories; those that are held more widely are examples that people copy.

    Null text: no spans. Null owner: an owner of its own. Null and repeated ids are returned as
    they are; equal rows count once as holders. An empty table gives no rows. Other columns are
    ignored. Long texts are searched whole.
    """
    # The texts are searched once: what is found is far smaller and is read several times.
    found = materialise(spans_of(documents, id_col=id_col, text_col=text_col, owner_col=owner_col), "secrets")
    rare = ownership(found).where((F.col("owners") <= max_owners) & ((F.col("owners") == 1) | (F.col("repositories") <= max_repositories))).select("secret")
    spans = F.explode(F.concat("base", "tokens")).alias("x")
    own = found.where(F.size("base") + F.size("tokens") > 0).select("row_id", spans).withColumn("secret", _secret(F.col("x"))).join(rare, "secret", "left_semi")
    # Spans are collected within one document: no more than its text holds.
    mine = own.groupBy("row_id").agg(F.array_sort(F.collect_set("x")).alias("mine"))
    joined = found.drop("tokens").join(mine, "row_id", "left").withColumn("mine", F.coalesce("mine", F.array().cast(_SPAN)))
    is_base = lambda x: x["kind"] < 3
    return joined.select("doc_id", "owner", "text_hash", "base", F.filter("mine", lambda x: ~is_base(x)).alias("owned"), F.size(F.filter("mine", is_base)).cast("long").alias("n_base_owned"))


def digests(spans: DataFrame) -> DataFrame:
    """The counts per kind, the digest of the base spans, and all spans as text."""
    of = lambda k: F.size(F.filter("base", lambda x: x["kind"] == k)).cast("long")
    return spans.select("doc_id", of(0).alias("n_assign"), of(1).alias("n_access"), of(2).alias("n_hex"), F.sha2(_render(F.col("base")).cast("binary"), 256).alias("base_sha256"), _render(F.array_sort(F.concat("base", "owned"))).alias("spans"), F.size("owned").cast("long").alias("n_owned"), "n_base_owned")


#: A text is cut into pieces of so many characters, so that no span is counted off from its beginning.
PIECE = 4096


def _between(pieces: Column, start: Column, end: Column) -> Column:
    """The characters from start to end of a text given in pieces of PIECE."""
    a, b = (start / PIECE).cast("int"), ((end - 1) / PIECE).cast("int")
    head = F.substring(F.get(pieces, a), start % PIECE + 1, F.least(end - start, F.lit(PIECE)))
    middle = F.array_join(F.slice(pieces, a + 2, F.greatest(b - a - 1, F.lit(0))), "")
    tail = F.substring(F.get(pieces, b), F.lit(1), (end - 1) % PIECE + 1)
    return F.when(end <= start, "").when(a == b, head).otherwise(F.concat(head, middle, tail))


def _redacted(body: Column, spans: Column) -> Column:
    """body with every span, or run of spans that overlap, as one mark."""
    ends = running(F.transform(spans, lambda x: x["end"]), lambda a, b: F.greatest(a, b), 0)
    before = F.concat(F.array(F.lit(0)), ends)
    cuts = F.zip_with(F.concat(F.transform(spans, lambda x: x["start"]), F.array(F.length(body))), before, lambda start, end: F.struct(start.alias("start"), end.alias("end")))
    # A span that begins inside what is marked already only carries the mark on; the last cut is the text's end.
    kept = F.filter(cuts, lambda c: c["start"] >= c["end"])
    pieces = F.regexp_extract_all(body, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))
    # Both are bound as variables once, not computed again for each cut.
    both = F.array(F.struct(pieces.alias("pieces"), kept.alias("cuts")))
    texts = F.transform(both, lambda b: F.transform(b["cuts"], lambda c: _between(b["pieces"], c["end"], c["start"])))
    return F.array_join(texts[0], REDACTED)


def redact(documents: DataFrame, *, owner_col: str = "source") -> DataFrame:
    """The documents with every span replaced by a mark; the columns stay those of documents.

    A document is its id, text and owner: rows equal in these are redacted alike, and every row
    stays. Null text stays null. Null ids and owners are values like any other. n_chars follows the
    text if there is such a column. Other columns stay, whatever their names. An empty table gives
    no rows.
    """
    spans = secret_spans(documents, owner_col=owner_col).where(F.size("base") + F.size("owned") > 0)
    names = ["m_id", "m_null", "m_owner", "m_free", "m_hash"]

    def place(doc: Column, owner: Column, text_hash: Column) -> list[Column]:
        cols = (F.coalesce(doc, F.lit(0)), doc.isNull(), F.coalesce(owner, F.lit("")), owner.isNull(), text_hash)
        return [c.alias(n) for c, n in zip(cols, names, strict=True)]

    found = spans.select(*place(F.col("doc_id"), F.col("owner"), F.col("text_hash")), F.array_sort(F.concat("base", "owned")).alias("spans"))
    marks = materialise(found.groupBy(*names).agg(F.first("spans").alias("spans")), "marks")
    sent = few(marks.select(*names), extra="length(m_owner)")
    where = place(F.col("doc_id").cast("long"), F.col(owner_col).cast("string"), F.xxhash64(F.coalesce("text", F.lit(""))))
    carried = documents.select(F.struct("*").alias("row"), *where)
    whole = carried.join(sent, names, "left_anti").select("row.*")
    # Only texts with spans are written anew.
    size = "length(m_owner) + 32 * size(spans) + aggregate(spans, 0L, (a, x) -> a + length(x.value))"
    hit = carried.join(few(marks, extra=size), names).select("row", _redacted(F.col("row")["text"], F.col("spans")).alias("body"))
    put = {"text": F.col("body")}
    if "n_chars" in documents.columns:
        put["n_chars"] = F.length("body").cast(documents.schema["n_chars"].dataType)
    return whole.unionByName(hit.select(*[put.get(c, F.col("row")[c]).alias(c) for c in documents.columns]))
