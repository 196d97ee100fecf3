"""Package manifests: own name, declared dependencies, and the line that declares one. One small reader a format.

Arrow batches carry the files to these readers, as JSON and TOML tables of any shape have no column function.
"""

from __future__ import annotations

import functools
import json
import re
import tomllib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: a requirement begins with the name of its distribution (PEP 508)
_NAME = re.compile(r"\s*([A-Za-z0-9](?:[A-Za-z0-9._-]*[A-Za-z0-9])?)")
#: specifications that point into the same repository
_LOCAL_SPECS = ("file:", "link:", "workspace:")
_LOCAL_KEYS = {"path", "git", "workspace"}


@functools.lru_cache(1 << 16)
def normal(name: str) -> str:
    """Lower case, runs of separators as one dash (PEP 503)."""
    return re.sub(r"[-_.]+", "-", name.strip()).lower()


def _named(requirement) -> str | None:
    found = _NAME.match(requirement) if isinstance(requirement, str) else None
    return found.group(1) if found else None


@functools.lru_cache(1 << 16)
def _of_line(line: str) -> str | None:
    """The distribution that a line of a requirements file names; options and comments name none."""
    line = line.partition("#")[0].strip()
    return None if line.startswith("-") else _named(line)


def _requirements(text: str):
    return None, filter(None, map(_of_line, text.splitlines()))


def _package_json(text: str):
    table = json.loads(text)
    wanted = table.get("dependencies") or {}
    return table.get("name"), [k for k in wanted if isinstance(wanted[k], str) and not wanted[k].startswith(_LOCAL_SPECS)]


def _pyproject(text: str):
    project = tomllib.loads(text).get("project") or {}
    return project.get("name"), filter(None, map(_named, project.get("dependencies") or ()))


def _cargo(text: str):
    table = tomllib.loads(text)

    def outside(spec) -> bool:
        return not isinstance(spec, dict) or not any(spec.get(k) for k in _LOCAL_KEYS)

    return (table.get("package") or {}).get("name"), [k for k, v in (table.get("dependencies") or {}).items() if outside(v)]


READERS: dict[str, Callable] = {"requirements.txt": _requirements, "package.json": _package_json, "pyproject.toml": _pyproject, "Cargo.toml": _cargo}


def read_manifest(file: str, text: str) -> tuple[str | None, list[str]]:
    """(own package name, direct runtime dependencies) of one manifest; anything unreadable or unknown gives none."""
    if file not in READERS:
        return None, []
    try:
        own, names = READERS[file](text)
        return (normal(own) if isinstance(own, str) else None), sorted(set(map(normal, names)))
    except (ValueError, TypeError, AttributeError):
        return None, []


#: fixed value: so many manifests are taken out of an Arrow batch at a time, so a worker holds few of them as objects
SLICE = 256
READ = "own_name string, deps array<string>"


def manifest(file: Column | str, text: Column | str) -> Column:
    """struct<own_name, deps> of a manifest, beside the other columns of its row."""
    import pyarrow as pa

    kind = pa.struct([("own_name", pa.string()), ("deps", pa.list_(pa.string()))])

    def run(files, texts):
        parts = []
        for at in range(0, len(files), SLICE):
            got = (read_manifest(f, t or "") for f, t in zip(files.slice(at, SLICE).to_pylist(), texts.slice(at, SLICE).to_pylist(), strict=True))
            parts.append(pa.array([{"own_name": own, "deps": deps} for own, deps in got], kind))
        return pa.concat_arrays(parts) if parts else pa.array([], kind)

    # not deterministic, so that it is not repeated in each column and filter that uses it
    return F.arrow_udf(run, READ, F.ArrowUDFType.SCALAR).asNondeterministic()(file, text)


def parse_manifests(manifests: DataFrame) -> DataFrame:
    """``manifests(id, file, text)`` -> (id, file, own_name, deps)."""
    return manifests.select("id", "file", manifest("file", "text").alias("_m")).select("id", "file", "_m.own_name", "_m.deps")


def _object_lines(text: str) -> tuple[int, int]:
    """First and last character of the object under the key "dependencies"; the JSON decoder finds its end."""
    key = re.search(r'"dependencies"\s*:\s*(?=\{)', text)
    if not key:
        return 0, 0
    return key.end(), json.JSONDecoder().raw_decode(text, key.end())[1]


def _table_lines(text: str, header: str) -> tuple[int, int]:
    """First and last character of a TOML table: from behind its header to the next one."""
    head = re.search(rf"^[ \t]*\[{re.escape(header)}\][^\n]*$", text, re.M)
    if not head:
        return 0, 0
    following = re.compile(r"^[ \t]*\[", re.M).search(text, head.end())
    return head.end(), following.start() if following else len(text)


def _list_lines(text: str) -> tuple[int, int]:
    """First and last character of the list ``dependencies`` of the project table: it ends with the first line that closes it as TOML."""
    start, stop = _table_lines(text, "project")
    key = re.compile(r"^[ \t]*dependencies[ \t]*=[ \t]*(?=\[)", re.M).search(text, start, stop)
    end = key.end() if key else stop
    while key and end < len(text):
        end = text.find("]", end) + 1 or len(text)
        try:
            tomllib.loads("x = " + text[key.end() : end])
            return key.end(), end
        except tomllib.TOMLDecodeError:
            continue
    return 0, 0


def dependency_line(file: str, text: str, package: str) -> str:
    """The source line that declares a direct dependency, searched in the right part of the file only; raises where there is none."""
    package = normal(package)
    if file == "requirements.txt":
        lines = ((line, _of_line(line)) for line in text.splitlines())
    else:
        places = {"package.json": _object_lines, "pyproject.toml": _list_lines, "Cargo.toml": lambda t: _table_lines(t, "dependencies")}
        start, stop = places[file](text) if file in places else (0, 0)
        token = {"package.json": r'"([^"\n]+)"\s*:', "pyproject.toml": r"[\"']\s*([A-Za-z0-9][A-Za-z0-9._-]*)", "Cargo.toml": r"^[ \t]*[\"']?([A-Za-z0-9_-]+)[\"']?[ \t]*[.=]"}.get(file, r"(?!)")
        found = re.compile(token, re.M).finditer(text, start, stop)
        edges = ((text.rfind("\n", 0, m.start(1)) + 1, m.end(1), m.group(1)) for m in found)
        lines = ((text[a : text.find("\n", b) if "\n" in text[b:] else len(text)], name) for a, b, name in edges)
    for line, name in lines:
        if name and normal(name) == package:
            return line.removesuffix("\r")
    raise ValueError(f"no line of {file} declares {package}")


def dependency_lines(manifests: DataFrame) -> DataFrame:
    """``manifests(id, file, text, package)`` -> (id, line); a manifest that does not declare its package fails the query."""

    import pyarrow as pa

    def run(*columns):
        parts = (zip(*(c.slice(at, SLICE).to_pylist() for c in columns), strict=True) for at in range(0, len(columns[0]), SLICE))
        return pa.array((dependency_line(*row) for part in parts for row in part), pa.string())

    line = F.arrow_udf(run, "string", F.ArrowUDFType.SCALAR).asNondeterministic()
    return manifests.select("id", line("file", "text", "package").alias("line"))
