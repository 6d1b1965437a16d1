"""Offline checks of connection and read options. Every problem is returned; nothing is raised."""

from __future__ import annotations

import re

from .. import errors
from . import location

# The options of a connection, and those of a read with their types.
S3_OPTIONS = ["region", "access_key_id", "secret_access_key", "session_token", "endpoint", "url_style", "use_ssl"]
AZURE_OPTIONS = ["account_name", "account_key", "connection_string", "tenant_id", "client_id", "client_secret"]
URL_STYLES = ["vhost", "path"]
READ_OPTIONS = {"path": str, "version": int, "union_by_name": bool}
CALENDAR_TOKEN = re.compile(r"\{[yMdHhms][yMdHhms\-_/:. ]*\}")


def _problem(code: str, what: str, next_step: str) -> str:
    return str(errors.LakeError(code, what, next_step))


def check_connection(options: dict) -> list[str]:
    found, kind, root = [], None, options.get("root")
    if not isinstance(root, str) or not root.strip():
        found.append(_problem(errors.UNSUPPORTED_ROOT, "a connection needs a root", "set 'root' to an absolute path or a URI"))
    else:
        try:
            kind = location.classify(root)
        except errors.LakeError as e:
            found.append(str(e))
    for family, names in ((location.S3, S3_OPTIONS), (location.AZURE, AZURE_OPTIONS)):
        if kind not in (None, family):
            found += [_problem(errors.OPTION_MISMATCH, f"'{k}' is for {family} roots, and the root is {kind}", f"remove '{k}'") for k in names if k in options]
    for k in sorted(set(options) - {"root", *S3_OPTIONS, *AZURE_OPTIONS}):
        found.append(_problem(errors.OPTION_MISMATCH, f"'{k}' is not a connection option", f"remove '{k}'"))
    if options.get("url_style") not in (None, *URL_STYLES):
        found.append(_problem(errors.OPTION_MISMATCH, "'url_style' is neither vhost nor path", "correct 'url_style'"))
    if "use_ssl" in options and not isinstance(options["use_ssl"], bool):
        found.append(_problem(errors.OPTION_MISMATCH, "'use_ssl' is not a boolean", "give true or false"))
    halves = [k for k in ("access_key_id", "secret_access_key") if options.get(k)]
    if len(halves) == 1:
        other = "secret_access_key" if halves == ["access_key_id"] else "access_key_id"
        found.append(_problem(errors.OPTION_MISMATCH, f"'{other}' is needed beside '{halves[0]}'", "give both, or neither to use the surrounding credentials"))
    return found


def check_read(options: dict) -> list[str]:
    found = []
    for k, v in options.items():
        kind = READ_OPTIONS.get(k)
        if kind is None:
            found.append(_problem(errors.READ_FAILED, f"'{k}' is not a read option", f"use one of {', '.join(READ_OPTIONS)}"))
        elif not isinstance(v, kind) or (kind is int and isinstance(v, bool)):
            code = errors.VERSION_VALUE if k == "version" else errors.READ_FAILED
            found.append(_problem(code, f"'{k}' is not of type {kind.__name__}", f"correct '{k}'"))
        elif k == "path" and CALENDAR_TOKEN.search(v):
            found.append(_problem(errors.READ_FAILED, "'path' holds a calendar token, and tables are partitioned by columns", "name the table's folder"))
        elif k == "version" and v < 0:
            found.append(_problem(errors.VERSION_VALUE, "'version' is negative", "give a version from 0 on"))
    return found


def parse_version(value: object) -> int | None:
    """A version as a whole number of 64 bits, given as such or as its digits."""
    if value is None:
        return None
    if isinstance(value, bool) or not re.fullmatch(r"-?\d+", str(value).strip()) or not 0 <= int(str(value)) < 1 << 63:
        raise errors.LakeError(errors.VERSION_VALUE, "the version is not a whole number from 0 to 2^63 - 1", "give a version that the table has")
    return int(str(value))
