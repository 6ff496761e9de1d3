"""Secret scans: candidate spans, and how many owners hold each candidate's value."""

from pyspark.sql import Column, DataFrame, functions as F

from newsloom.functions.search import count_up_to, once, prefix_maxima, prefix_sums
from newsloom.functions.steps import computed_once
from newsloom.llm.shared import column, row_id, written

#: Kinds in the order of the digest: pattern, the group that holds the value, the least length of the value.
KINDS = {
    "assign": (r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    "access": (r"AKIA[A-Z0-9]+", 0, 20),
    "hex": (r"[0-9a-f]{24,}", 0, 24),
    "opaque": (r"[A-Za-z0-9_-]{20,}", 0, 20),
}
BASE = ("assign", "access", "hex")
ADDED = "opaque"
#: More spans of a kind than a text can have.
MOST_SPANS = (1 << 30) - 1
#: Characters of a text that are looked through for a cut in it.
PART = 4096
_SPAN = "array<struct<start:bigint,rank:int,end:bigint,value:string>>"


def _spans(kind: str) -> Column:
    """Spans of a kind from its matches and the pieces between them, whose
    lengths add up to the places. Matches with a short value are dropped after
    the search, so they still use up their characters."""
    rank, (_, _, least) = list(KINDS).index(kind), KINDS[kind]
    whole, value, piece = F.col(f"{kind}_whole"), F.col(f"{kind}_value"), F.col(f"{kind}_pieces")
    before = F.slice(piece, F.lit(1), F.size(whole))
    ends = prefix_sums(F.zip_with(before, whole, lambda p, w: F.length(p) + F.length(w)))
    found = once(ends, lambda ends: F.transform(whole, lambda w, i: F.struct(
        (F.get(ends, i) - F.length(w)).alias("start"), F.lit(rank).alias("rank"), F.get(ends, i).alias("end"), F.get(value, i).alias("value"))))
    found = F.filter(found, lambda s: F.length(s["value"]) >= least)
    return F.when(F.size(whole) > 0, found).otherwise(F.array().cast(_SPAN))


def _looks_live(value: Column) -> Column:
    """Letters and digits, ten or more different characters."""
    return value.rlike("[0-9]") & value.rlike("[A-Za-z]") & (F.size(F.array_distinct(F.split(value, ""))) >= 10)


def _with_spans(df: DataFrame) -> DataFrame:
    """Adds `spans` (start, rank, end, value), sorted, to a frame with `text`."""
    own = df.columns
    wholes = [F.regexp_extract_all("text", F.lit(p), F.lit(0)).alias(f"{k}_whole") for k, (p, _, _) in KINDS.items()]
    df = computed_once(df.select(*own, *wholes), *(f"{k}_whole" for k in KINDS))
    some = lambda kind: F.size(f"{kind}_whole") > 0
    more = []
    for kind, (pattern, group, _) in KINDS.items():
        value = F.when(some(kind), F.regexp_extract_all("text", F.lit(pattern), F.lit(group))) if group else F.col(f"{kind}_whole")
        more += [value.alias(f"{kind}_value"), F.when(some(kind), F.split("text", pattern, -1)).alias(f"{kind}_pieces")]
    df = computed_once(df.select("*", *more), *(f"{k}_{x}" for k in KINDS for x in ("value", "pieces")))
    df = df.select(*own, *(_spans(kind).alias(kind) for kind in (*BASE, ADDED)))
    df = computed_once(df, *BASE, ADDED)
    starts = [F.transform(kind, lambda s: s["start"]).alias(f"{kind}_starts") for kind in BASE]
    df = computed_once(df.select("*", *starts), *(f"{kind}_starts" for kind in BASE))

    def apart(a, kind):
        """Spans of a kind lie apart and in order, so only the last that begins before a's end can reach into it."""
        last = F.get(kind, count_up_to(F.col(f"{kind}_starts"), a["end"] - 1, MOST_SPANS) - 1)
        return F.coalesce(last["end"] <= a["start"], F.lit(True))

    added = F.filter(ADDED, lambda a: _looks_live(a["value"]) & apart(a, BASE[0]) & apart(a, BASE[1]) & apart(a, BASE[2]))
    return computed_once(df.select(*own, F.sort_array(F.concat(*BASE, added)).alias("spans")), "spans")


def ownership(found: DataFrame) -> DataFrame:
    """(key, n_owners, n_repos) of candidate hashes in a frame (key, owner, repo).

    Counted in steps, each added up before its shuffle, so a value that is
    everywhere is no larger than any other.
    """
    repos = found.select("key", "owner", "repo").distinct()
    owners = repos.groupBy("key", "owner").agg(F.count("*").alias("n"))
    return owners.groupBy("key").agg(F.count("*").alias("n_owners"), F.sum("n").alias("n_repos"))


def _classified(scanned: DataFrame, max_owners: int) -> DataFrame:
    """One row per span that is reported: n (row), start, rank, end, live."""
    each = scanned.filter(F.size("spans") > 0).select("n", "owner", "repo", F.explode("spans").alias("span"))
    each = written(each.select("n", "owner", "repo", "span.start", "span.rank", "span.end", F.sha2("span.value", 256).alias("key"),
                               _looks_live(F.col("span.value")).alias("looks")))
    shared = ownership(each)
    each = each.join(shared, "key").withColumn("copied", F.col("n_owners") > max_owners)
    each = each.withColumn("live", ~F.col("copied") & F.col("looks"))
    added = list(KINDS).index(ADDED)
    return each.filter((F.col("rank") != added) | F.col("live"))


def _joined(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["rank"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def secret_scan(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", repo_col: str = "doc_id",
    max_owners: int = 2,
) -> DataFrame:
    """One row per input row: id_col, n_assign, n_access, n_hex, base_sha256,
    spans (kind:start:end, code points), n_live, n_copied.

    Base spans are always reported. Other long runs of letters and digits are
    candidates, reported as `opaque` only if they look live and belong to few:
    over the whole corpus at most `max_owners` owners have the value. Reported
    spans count as live (owner-specific, live-looking) or copied (held by more
    owners). A repository is a pair of owner and repo_col.

    Null text counts as empty and has no span. Null owners are one owner, null
    repositories one repository of their owner. Repeated rows keep a row each
    and are one repository. Extra columns are left out.
    """
    slim = df.select(
        column(id_col).alias("id"), column(owner_col).cast("string").alias("owner"), column(repo_col).cast("string").alias("repo"),
        F.coalesce(column(text_col), F.lit("")).alias("text"), row_id().alias("n"))
    scanned = written(_with_spans(slim).drop("text"))
    count = lambda test: F.count_if(test)
    of_row = _classified(scanned, max_owners).groupBy("n").agg(
        F.sort_array(F.collect_list(F.struct("start", "rank", "end"))).alias("spans"),
        *(count(F.col("rank") == i).alias(f"n_{kind}") for i, kind in enumerate(BASE)),
        count(F.col("live")).alias("n_live"), count(F.col("copied")).alias("n_copied"))
    none = F.array().cast("array<struct<start:bigint,rank:int,end:bigint>>")
    out = scanned.drop("spans").join(of_row, "n", "left").withColumn("spans", F.coalesce("spans", none))
    base = F.filter("spans", lambda s: s["rank"] < len(BASE))
    zero = F.lit(0).cast("bigint")
    return out.select(
        F.col("id").alias(id_col), *(F.coalesce(f"n_{kind}", zero).alias(f"n_{kind}") for kind in BASE),
        F.sha2(_joined(base), 256).alias("base_sha256"), _joined(F.col("spans")).alias("spans"),
        F.coalesce("n_live", zero).alias("n_live"), F.coalesce("n_copied", zero).alias("n_copied"))


def masked(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", owner_col: str = "source", repo_col: str = "doc_id",
    max_owners: int = 2, live: str = "[secret]", copied: str = "[example]",
) -> DataFrame:
    """The rows of `df` with every reported span of their texts replaced: by
    `copied` where many owners have the value, by `live` otherwise. Overlapping
    spans are replaced as one, by `live` if any of them is not copied.

    Only rows with spans are joined; the rest, null texts included, pass by.
    """
    rows = df.select(
        F.struct("*").alias("row"), column(owner_col).cast("string").alias("owner"),
        column(repo_col).cast("string").alias("repo"), F.coalesce(column(text_col), F.lit("")).alias("text"), row_id().alias("n"))
    rows = written(_with_spans(rows).drop("text"))
    spans = _classified(rows.drop("row"), max_owners).groupBy("n").agg(
        F.sort_array(F.collect_list(F.struct("start", "end", "copied"))).alias("marks"))
    text = F.col("row")[text_col]

    def runs_of(marks):
        """Marks that touch nothing before them begin a run; it is live if any of its marks is."""
        highest = prefix_maxima(F.transform(marks, lambda m: m["end"]))
        living = prefix_sums(F.transform(marks, lambda m: (~m["copied"]).cast("int")))
        return once(F.struct(highest.alias("end"), living.alias("live")), lambda so_far: once(
            F.concat(F.filter(F.transform(marks, lambda m, i: F.when(
                (i == 0) | (F.get(so_far["end"], i - 1) <= m["start"]), i)), lambda i: i.isNotNull()), F.array(F.size(marks))),
            lambda firsts: F.transform(F.slice(firsts, F.lit(1), F.size(firsts) - 1), lambda first, k: F.struct(
                F.get(marks, first)["start"].alias("start"), F.get(so_far["end"], F.get(firsts, k + 1) - 1).alias("end"),
                (F.get(so_far["live"], F.get(firsts, k + 1) - 1) == F.coalesce(F.get(so_far["live"], first - 1), F.lit(0))).alias("copied")))))

    def between(parts, start, end):
        """Characters start to end of a text in parts of equal length."""
        first, last = F.floor(start / PART).cast("int"), F.floor(end / PART).cast("int")
        low, high = (start % PART).cast("int"), (end % PART).cast("int")
        part = lambda i: F.coalesce(F.get(parts, i), F.lit(""))
        over = F.concat(F.substring(part(first), low + 1, F.lit(PART)), F.array_join(F.slice(parts, first + 2, last - first - 1), ""), F.substring(part(last), F.lit(1), high))
        return F.when(first == last, F.substring(part(first), low + 1, high - low)).otherwise(over)

    def rewritten(parts, runs, length):
        pieces = F.transform(runs, lambda run, k: F.concat(
            between(parts, F.coalesce(F.get(runs, k - 1)["end"], F.lit(0).cast("bigint")), run["start"]), F.when(run["copied"], copied).otherwise(live)))
        return F.concat(F.array_join(pieces, ""), between(parts, F.coalesce(F.get(runs, F.size(runs) - 1)["end"], F.lit(0).cast("bigint")), length))

    marked = rows.filter(F.size("spans") > 0).join(spans, "n", "left")
    none = F.array().cast("array<struct<start:bigint,end:bigint,copied:boolean>>")
    marked = marked.withColumns({
        "runs": once(F.coalesce("marks", none), runs_of), "parts": F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PART}}}"), F.lit(0))})
    marked = computed_once(marked, "runs", "parts")
    marked = computed_once(marked.withColumn("new", rewritten(F.col("parts"), F.col("runs"), F.length(text).cast("bigint"))), "new")
    new = marked.select(*(
        F.col("new").alias(c) if c == text_col else F.col("row")[c].alias(c) for c in df.columns))
    return rows.filter(F.size("spans") == 0).select("row.*").unionByName(new)
