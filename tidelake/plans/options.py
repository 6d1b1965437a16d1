"""Write options, all checked before a table is opened; every problem is told at once."""

from __future__ import annotations

from dataclasses import dataclass, field

from .. import errors

# Fixed values.
STRATEGIES = ["append", "replace", "merge"]
OPTIONS = ["path", "partition_by", "merge_predicate", "target_file_bytes"]
DEFAULT_FILE_BYTES = 128 << 20


@dataclass(frozen=True)
class WriteSpec:
    strategy: str
    keys: list[str] = field(default_factory=list)
    partition_by: list[str] | None = None
    merge_predicate: str | None = None
    target_file_bytes: int = DEFAULT_FILE_BYTES
    path: str | None = None
    evolve: bool = False


def distance(a: str, b: str) -> int:
    """Edits between two names."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        before, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, before + (x != y))
    return row[-1]


def _unknown(name: str) -> str:
    if name == "mode":
        return "'mode' is not a write option; give the strategy instead"
    if name == "version":
        return "'version' is for reads; a write goes to the latest version"
    near = min(OPTIONS, key=lambda o: (distance(name, o), o))
    return f"'{name}' is not a write option" + (f"; did you mean '{near}'?" if distance(name, near) <= 3 else "")


def parse(strategy: str, options: dict | None = None, keys: list[str] | None = None, schema_policy: str | None = None, incremental: bool = False, duplicates: str | None = None) -> WriteSpec:
    """The options of a write; schema_policy widens the table only if it is exactly "evolve"."""
    options, problems = dict(options or {}), []
    if strategy not in STRATEGIES:
        problems.append(f"the strategy is not one of {', '.join(STRATEGIES)}")
    problems += [_unknown(k) for k in options if k not in OPTIONS]
    partition_by = options.get("partition_by")
    if partition_by is not None:
        names = [partition_by] if isinstance(partition_by, str) else partition_by
        if not isinstance(names, (list, tuple)) or not names or not all(isinstance(n, str) and n.strip() for n in names):
            problems.append("'partition_by' is not a name or a list of names")
        else:
            partition_by = [n.strip() for n in names]
            if len(set(partition_by)) < len(partition_by):
                problems.append("'partition_by' names a column twice")
    size = options.get("target_file_bytes", DEFAULT_FILE_BYTES)
    try:
        if isinstance(size, (bool, float)) or not 0 < int(size) < 1 << 63:
            raise ValueError
        size = int(size)
    except (TypeError, ValueError):
        problems.append("'target_file_bytes' is not a whole number above 0")
    for name in ("path", "merge_predicate"):
        if options.get(name) is not None and not isinstance(options[name], str):
            problems.append(f"'{name}' is not a text")
    if incremental and strategy == "append" and duplicates != "accept":
        problems.append("an incremental append can repeat rows; set duplicates to 'accept' or merge by keys")
    if "version" in options and len(problems) == 1:
        raise errors.LakeError(errors.VERSION_ON_WRITE, problems[0], "remove 'version'")
    if problems:
        raise errors.LakeError(errors.WRITE_OPTION, "; ".join(problems), "correct the write's options")
    if strategy == "merge" and not keys:
        raise errors.LakeError(errors.MERGE_WITHOUT_KEYS, "a merge needs keys", "name the columns that identify a row")
    return WriteSpec(strategy, list(keys or []), partition_by, options.get("merge_predicate"), size, options.get("path"), schema_policy == "evolve")
