"""Privacy projections and leak scans."""

from __future__ import annotations

import bisect
import json
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.scalars import fully_decoded

#: fixed values: keys that name a person
PERSON_KEYS = (
    "login", "avatar_url", "gravatar_id", "email", "user_view_type",
    "followers_url", "following_url", "gists_url", "starred_url",
    "subscriptions_url", "organizations_url", "received_events_url",
    "owner", "organization", "author", "committer", "maintainer",
)


def allow(df: DataFrame, names: list[str], nested: dict[str, list[str]] | None = None) -> DataFrame:
    """Default-deny: the listed columns that exist, and of structs only the listed fields."""
    out = [F.col(c) for c in names if c in df.columns]
    for c, fields in (nested or {}).items():
        if c in df.columns:
            out.append(F.struct(*(F.col(f"{c}.{f}").alias(f) for f in fields)).alias(c))
    return df.select(*out)


def person_paths(schema: T.DataType, at: str = "$") -> list[str]:
    """Paths of person keys in a typed schema."""
    found = []
    if isinstance(schema, T.StructType):
        for f in schema.fields:
            path = f"{at}.{f.name}"
            if f.name in PERSON_KEYS:
                found.append(path)
            found += person_paths(f.dataType, path)
    elif isinstance(schema, T.ArrayType):
        found += person_paths(schema.elementType, at + "[]")
    elif isinstance(schema, T.MapType):
        found += person_paths(schema.valueType, at + ".*")
    return found


def json_nodes(df: DataFrame, key: str, column: str) -> DataFrame:
    """(key, path, name, value, leaf) of every member and item at every level of a JSON column; unreadable JSON gives none.

    One pass in Arrow batches walks each row with a stack of its own, so the plan is the same whatever a row's nesting. Numbers
    keep the text they have in the JSON. Nested beyond what the JSON library reads (thousands of levels) is unreadable.
    """
    kind = df.schema[key].dataType
    schema = T.StructType([T.StructField(key, kind), T.StructField("path", T.StringType()), T.StructField("name", T.StringType()), T.StructField("value", T.StringType()), T.StructField("leaf", T.BooleanType())])

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            rows, out, size = [], [], 0
            for i, text in enumerate(batch.column(1).to_pylist()):
                for node in walk_json(text):
                    rows.append(i)
                    out.append(node)
                    size += len(node[0]) + len(node[2] or "")
                    if size > 4 << 20:
                        yield send(pa, batch, rows, out)
                        rows, out, size = [], [], 0
            if out:
                yield send(pa, batch, rows, out)

    def send(pa, batch, rows, out):
        path, name, value, leaf = zip(*out, strict=True)
        columns = [batch.column(0).take(pa.array(rows)), pa.array(path, pa.string()), pa.array(name, pa.string()), pa.array(value, pa.string()), pa.array(leaf, pa.bool_())]
        return pa.RecordBatch.from_arrays(columns, [key, "path", "name", "value", "leaf"])

    return df.select(key, F.col(column).cast("string").alias("_json")).where("_json IS NOT NULL").mapInArrow(run, schema)


def walk_json(text: str) -> Iterator[tuple[str, str | None, str | None, bool]]:
    """(path, name, value, leaf) of what lies below the root of a JSON text, in document order."""
    try:
        root = json.loads(text, parse_int=str, parse_float=str)
    except (ValueError, RecursionError):
        return
    stack = [("$", None, root)]
    while stack:
        path, name, v = stack.pop()
        inner = isinstance(v, (dict, list))
        if path != "$":
            yield path, name, None if inner or v is None else str(v).lower() if isinstance(v, bool) else v, not inner
        if isinstance(v, dict):
            stack += [(f"{path}.{k}", k, x) for k, x in reversed(v.items())]
        elif inner:
            stack += [(f"{path}[{i}]", None, x) for i, x in reversed(list(enumerate(v)))]


def json_leaves(df: DataFrame, key: str, column: str) -> DataFrame:
    """(key, path, value) of every scalar in a JSON column, at any depth; unreadable JSON gives none."""
    return json_nodes(df, key, column).where("leaf").select(key, "path", "value")


def person_fields(df: DataFrame, key: str, column: str) -> DataFrame:
    """Paths of person keys found anywhere in a JSON column, whether they hold a scalar or a container."""
    return json_nodes(df, key, column).where(F.col("name").isin(*PERSON_KEYS)).select(key, "path")


def public_projection(rows: DataFrame, owners: DataFrame) -> DataFrame:
    """Rows fit to publish: user-owned ones lose the slug and any homepage that holds the handle; an unknown owner raises."""
    j = rows.join(owners.select("github_repo", "owner_type", F.col("full_name").alias("_full")), "github_repo", "left")
    handle = F.lower(F.regexp_extract("github_repo", "^([^/]+)/", 1))
    leaks = F.lower(fully_decoded("homepage")).contains(handle)
    user = F.when(F.col("owner_type").isNull(), F.raise_error(F.concat(F.lit("unknown owner of "), F.col("github_repo"))).cast("boolean")).otherwise(F.col("owner_type") == "User")
    return j.withColumn("_u", user).select(
        *[c for c in rows.columns if c not in ("github_repo", "homepage")],
        F.when(F.col("_u"), F.lit(None)).otherwise(F.coalesce("_full", "github_repo")).alias("github_repo"), F.when(~(F.col("_u") & F.coalesce(leaks, F.lit(False))), F.col("homepage")).alias("homepage"),
    )


def handle_leaks(staged: DataFrame, handles: list[str]) -> DataFrame:
    """Rows whose text holds any handle of a short list."""
    text = F.lower(F.to_json(F.struct(*staged.columns)))
    hit = F.array_compact(F.array(*(F.when(text.contains(h.lower()), h) for h in handles)))
    return staged.withColumn("leaks", hit).where(F.size("leaks") > 0)


def _same_length_lower(text: str) -> str:
    """Lower case where that keeps the number of characters, so that places stay places."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(x if len(x := c.lower()) == 1 else c for c in text)


def _wordlike(c: str) -> bool:
    return c.isalpha() or c.isnumeric() or c == "_"


class TermWindows:
    """Names and terms in one automaton: a text is read once, however many there are."""

    def __init__(self, names: list[str], terms: list[str], window: int):
        import ahocorasick

        self.names, self.terms, self.window = names, terms, window
        kinds: dict[str, tuple[list[int], list[int]]] = {}
        for which, words in enumerate((names, terms)):
            for i, w in enumerate(words):
                if w:
                    kinds.setdefault(_same_length_lower(w), ([], []))[which].append(i)
        self.automaton = ahocorasick.Automaton()
        for w, kind in kinds.items():
            self.automaton.add_word(w, (len(w), *kind))
        if kinds:
            self.automaton.make_automaton()

    def find(self, text: str) -> Iterator[tuple[int, int, int, int]]:
        """(name, its place, term, its place): terms inside the window around a name; both stand alone, a window's edges count as gaps."""
        if not self.automaton:
            return
        low = _same_length_lower(text)
        edge = lambda i: not (0 <= i < len(low) and _wordlike(low[i]))
        named, told, last = [], [], {}
        for end, (size, names, terms) in self.automaton.iter(low):
            start = end + 1 - size
            if names and edge(start - 1) and edge(end + 1) and start >= last.get((size, names[0]), 0):
                last[size, names[0]] = end + 1
                named += [(start, end + 1, n) for n in names]
            told += [(start, end + 1, t) for t in terms]
        told.sort()
        starts = [x[0] for x in told]
        for at, stop, name in named:
            lo, hi = max(0, at - self.window), min(len(low), stop + self.window)
            free: dict[int, int] = {}  # per term, where its next match may begin
            for start, end, term in told[bisect.bisect_left(starts, lo) : bisect.bisect_left(starts, hi)]:
                alone = end <= hi and (start == lo or edge(start - 1)) and (end == hi or edge(end))
                if alone and start >= free.get(term, 0):
                    free[term] = end
                    if not (start == at and end == stop):
                        yield name, at, term, start


def window_terms(surfaces: DataFrame, names: list[str], terms: list[str], window: int = 120) -> DataFrame:
    """(doc, name, term, context): forbidden terms within ``window`` characters of a name; one automaton in Arrow batches."""
    schema = f"doc {surfaces.schema['doc'].dataType.simpleString()}, name string, term string, context string"

    def run(batches):
        import pyarrow as pa

        scan = TermWindows(names, terms, window)
        for batch in batches:
            rows, out = [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                for n, at, t, start in scan.find(text):
                    rows.append(i)
                    out.append((names[n], text[start : start + len(terms[t])], text[max(0, at - window) : at + len(names[n]) + window]))
            if out:
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), *(pa.array(c, pa.string()) for c in zip(*out, strict=True))], ["doc", "name", "term", "context"])

    return surfaces.select("doc", "surface").where("surface IS NOT NULL").mapInArrow(run, schema)


def leaf_terms(df: DataFrame, key: str, column: str, terms: list[str]) -> DataFrame:
    """(key, path, term): forbidden terms in the scalars of a JSON column."""
    found = F.explode(F.regexp_extract_all("value", F.lit(term_pattern(terms)), 1)).alias("term")
    return json_leaves(df, key, column).where("value IS NOT NULL").select(key, "path", found)


def term_pattern(terms: list[str]) -> str:
    return "(?i)(?<![\\p{L}\\p{N}_])(" + "|".join(terms) + ")(?![\\p{L}\\p{N}_])"


def page_terms(surfaces: DataFrame, terms: list[str]) -> DataFrame:
    """(doc, term) anywhere on a surface."""
    pattern = term_pattern(terms)
    return surfaces.select("doc", F.explode(F.regexp_extract_all("surface", F.lit(pattern), 1)).alias("term"))


def pinned(rows: DataFrame, pins: DataFrame) -> DataFrame:
    """Rows whose (system, package) equals the entity's verified pin."""
    return rows.join(pins.select("github_repo", "system", "package"), ["github_repo", "system", "package"])


def plane(velocity: Column, citation: Column) -> Column:
    """Where a point is drawn: the plane, one of the rails, or nowhere."""
    return F.when(velocity.isNull(), "excluded").when(citation.isNull(), "rail").otherwise("plane")
