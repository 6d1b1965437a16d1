"""Roots, and the tables below them."""

from __future__ import annotations

import re

from .. import errors

LOCAL, S3, AZURE = "local", "s3", "azure"

# URI schemes of each kind of root.
SCHEMES = {S3: ["s3", "s3a"], AZURE: ["az", "abfs", "abfss", "adl"], LOCAL: ["file"]}

_SCHEME = re.compile(r"([A-Za-z][A-Za-z0-9+.\-]*)://")


def scheme_of(location: str) -> str | None:
    found = _SCHEME.match(location)
    return found[1].lower() if found else None


def classify(root: str) -> str:
    """Whether a root is local, S3 or Azure; relative paths and other schemes are refused."""
    scheme = scheme_of(root)
    if scheme is None and root.startswith("/"):
        return LOCAL
    for kind, schemes in SCHEMES.items():
        if scheme in schemes:
            return kind
    raise errors.LakeError(errors.UNSUPPORTED_ROOT, f"the root is of an unsupported kind ({scheme or 'a relative path'})", "give an absolute path, or a URI of one of " + ", ".join(s for v in SCHEMES.values() for s in v))


def resolve(root: str, entity: str, path: str | None = None) -> str:
    """A table's location: `path` itself if it is absolute or a URI, else `path`, or the entity's name, below the root."""
    if path and (path.startswith("/") or scheme_of(path)):
        return path.rstrip("/") or "/"
    return root.rstrip("/") + "/" + (path or entity).strip("/")
