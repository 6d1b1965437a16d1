"""Coded errors: what went wrong, whether trying again can help, and what to do next."""

from __future__ import annotations

import re

# The meaning of each code.
UNSUPPORTED_ROOT = "LAKE0101"
OPTION_MISMATCH = "LAKE0102"
MERGE_WITHOUT_KEYS = "LAKE0103"
VERSION_ON_WRITE = "LAKE0105"
MERGE_PREDICATE = "LAKE0107"
WRITE_OPTION = "LAKE0108"
READ_FAILED = "LAKE0201"
VERSION_VALUE = "LAKE0202"
SCHEMA_MISMATCH = "LAKE0301"
UNWRITABLE_TYPE = "LAKE0302"
KEY_NOT_IN_SCHEMA = "LAKE0303"
UNQUOTABLE_NAME = "LAKE0304"
KEY_TYPE = "LAKE0305"
CONFLICT = "LAKE0401"
DUPLICATE_MATCH = "LAKE0402"
UNSAFE_STORE = "LAKE0403"
WRITE_FAILED = "LAKE0404"
UNMATCHABLE_KEY = "LAKE0405"
PARTITION_VALUE = "LAKE0406"

CODES = {
    UNSUPPORTED_ROOT: "the root is missing or not of a supported kind",
    OPTION_MISMATCH: "a connection option does not belong to this kind of root, or lacks its other half",
    MERGE_WITHOUT_KEYS: "a merge names no keys",
    VERSION_ON_WRITE: "a version was given for a write",
    MERGE_PREDICATE: "the merge predicate is not accepted",
    WRITE_OPTION: "a write option is unknown or has a bad value",
    READ_FAILED: "the table, or that version of it, could not be read",
    VERSION_VALUE: "the version is not a whole number from 0 to 2^63 - 1",
    SCHEMA_MISMATCH: "the data do not fit the table's schema",
    UNWRITABLE_TYPE: "a column has a type that tables cannot hold",
    KEY_NOT_IN_SCHEMA: "a merge key is not a column of the data",
    UNQUOTABLE_NAME: "a column name holds a double quote",
    KEY_TYPE: "a merge key has a type without equality",
    CONFLICT: "another writer came first, or the storage is not answering; trying again can help",
    DUPLICATE_MATCH: "several incoming rows match one row",
    UNSAFE_STORE: "the store cannot make commits safe",
    WRITE_FAILED: "the write failed",
    UNMATCHABLE_KEY: "a merge key is null or NaN and can match nothing",
    PARTITION_VALUE: "a value cannot be stored in its column: an empty or too long partition value, or a null where none may be",
}


class LakeError(Exception):
    """An error with a code. Its text never carries row data, predicates or credentials."""

    def __init__(self, code: str, what: str, next_step: str, transient: bool = False):
        super().__init__(f"{code}: {what}. Next step: {next_step}")
        self.code, self.transient = code, transient


class Cancelled(Exception):
    """The caller stopped the operation; passed on as it is."""


# Error conditions of Spark, exception names of Hadoop, and codes of object stores that tell the kinds of failure apart.
DUPLICATE_MARKS = ["MERGE_CARDINALITY_VIOLATION"]
SHAPE_MARKS = ["PARQUET_COLUMN_DATA_TYPE_MISMATCH", "SchemaColumnConvertNotSupportedException", "INCOMPATIBLE_DATA_FOR_TABLE", "NUM_COLUMNS_MISMATCH"]
NULL_MARKS = ["NOT_NULL_ASSERT_VIOLATION", "NOT_NULL_CONSTRAINT_VIOLATION"]
LONG_NAME_MARKS = ["File name too long", "PathComponentTooLongException", "KeyTooLongError"]
UNSAFE_MARKS = ["A header you provided implies functionality that is not implemented", "ConditionalWritesNotSupported"]
CONFLICT_MARKS = ["FileAlreadyExistsException", "PreconditionFailed", "ConditionalRequestConflict", "LeaseAlreadyPresent", "PathAlreadyExists"]
TRANSIENT_MARKS = [
    "SlowDown", "ServerBusy", "OperationTimedOut", "RequestTimeout", "ThrottlingException", "ServiceUnavailable", "SocketTimeoutException", "SocketException", "ConnectException",
    "ConnectTimeoutException", "NoRouteToHostException", "UnknownHostException", "StandbyException", "RetriableException", "SafeModeException", "Connection reset", "Connection refused", "Broken pipe", "Read timed out",
]
DENIED_MARKS = ["AccessDenied", "AccessControlException", "AuthorizationFailure", "AuthorizationPermissionMismatch", "InvalidAccessKeyId", "SignatureDoesNotMatch", "NoAuthWithAWSException"]
PREDICATE_ERRORS = ["AnalysisException", "ParseException", "NumberFormatException", "ArithmeticException", "IllegalArgumentException"]

HIDDEN = "<redacted>"
#: Parts of a name, as underscores, dots, hyphens and capitals divide it, that make what the name is given a credential.
SECRET_PARTS = {"secret", "secrets", "password", "passphrase", "passwd", "pwd", "pin", "token", "tokens", "credential", "credentials", "authorization", "auth", "cookie", "sas", "sig", "signature", "key", "keys", "apikey", "accesskey", "accountkey"}
#: Spark quotes values of rows after these words.
VALUE_WORDS = {"value", "values", "text", "string", "literal", "row", "key"}
_NAME = re.compile(r"[A-Za-z_][\w.\-]*")
_PART = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+")
_SPACE = re.compile(r"[ \t]*")


def is_secret(name: str) -> bool:
    """Whether a name, in any spelling, is that of a credential: fs.s3a.secret.key, AccountKey, sessionToken, AWS_ACCESS_KEY_ID."""
    parts = [p.lower() for p in _PART.findall(name)]
    return any(p in SECRET_PARTS for p in parts) or any(name.lower().endswith(s) for s in ("password", "secret", "token", "credential"))


def _end_of_value(text: str, at: int) -> int:
    """Where a value that starts at a place ends: at its closing quote, or before white space or a mark that ends it."""
    if at < len(text) and text[at] in "'\"`":
        end = text.find(text[at], at + 1)
        return len(text) if end < 0 else end + 1
    while at < len(text) and not text[at].isspace() and text[at] not in "&;,<>)]}":
        at += 1
    return at


def _without_values(text: str) -> str:
    """Each name that is a credential's keeps its place; what an equals sign or colon gives it does not. So do values that Spark quotes."""
    out, at = [], 0
    for m in _NAME.finditer(text):
        if m.start() < at:
            continue
        after = m.end()
        if after < len(text) and text[after] in "'\"" and m.start() and text[m.start() - 1] == text[after]:
            after += 1  # the name itself is quoted
        rest = _SPACE.match(text, after).end()
        if is_secret(m[0]) and rest < len(text) and text[rest] in ":=" and not text.startswith("://", rest):
            start = _SPACE.match(text, rest + 1).end()
            end = _end_of_value(text, start)
            while text[start:end].lower() in ("bearer", "basic", "sharedkey", "aws4-hmac-sha256") and end < len(text):  # a scheme goes before the credential
                end = _end_of_value(text, end + 1)
            out += [text[at:start], HIDDEN]
            at = end
        elif m[0].lower() in ("bearer", "sharedkey") and rest > after:
            out += [text[at:rest], HIDDEN]
            at = _end_of_value(text, rest)
        elif m[0].lower() in VALUE_WORDS:
            start = _SPACE.match(text, rest + 1 if text.startswith(":", rest) else rest).end()
            if start < len(text) and text[start] in "'\"":
                out += [text[at:start], HIDDEN]
                at = _end_of_value(text, start)
    return "".join(out) + text[at:]


def _without_elements(text: str) -> str:
    """XML elements whose names are credentials', as stores answer, lose their content."""
    out, at, missing = [], 0, set()
    while (start := text.find("<", at)) >= 0:
        name = _NAME.match(text, start + 1)
        closing = f"</{name[0]}>" if name and is_secret(name[0]) else ""
        end = text.find(closing, start) if closing and closing not in missing else -1
        if end < 0:
            missing.add(closing)  # nor is it anywhere after
        if end >= 0:
            out += [text[at:start], f"<{name[0]}>{HIDDEN}{closing}"]
            at = end + len(closing)
        else:
            out.append(text[at : start + 1])
            at = start + 1
    return "".join(out) + text[at:]


def _without_users(text: str) -> str:
    """Locations lose what stands before an at sign in their host."""
    parts = text.split("://")
    for i, part in enumerate(parts[1:], 1):
        host = re.split(r"[\s/]", part, maxsplit=1)[0]
        if "@" in host:
            user, _, _ = host.rpartition("@")
            # In abfss://container@account the part before the sign is no credential; a colon makes it one.
            if ":" in user or not parts[i - 1].endswith(("abfs", "abfss")):
                parts[i] = f"{HIDDEN}@{part[len(user) + 1 :]}"
    return "://".join(parts)


def _without_tables(text: str) -> str:
    """Rows printed as a table, whose lines start with a bar or a plus sign, become one mark."""
    out: list[str] = []
    for line in text.split("\n"):
        if line.lstrip().startswith(("|", "+-")):
            if not out or out[-1] != HIDDEN:
                out.append(HIDDEN)
        else:
            out.append(line)
    return "\n".join(out)


def redact(message: str) -> str:
    """The message without row data and anything shaped like a credential; rather too little is left than too much."""
    return _without_values(_without_users(_without_elements(_without_tables(message))))


def translate(error: BaseException, kind: str, operation: str, keys: list[str] | None = None, predicate: bool = False) -> LakeError:
    """The coded error for a failure of a "read", "write" or "merge".

    Coded errors are returned as they are and cancellations raised again. Otherwise the first of these kinds that the error, or what
    caused it, shows gives the code; some hold only for writes or merges.
    """
    if isinstance(error, LakeError):
        return error
    if isinstance(error, (Cancelled, KeyboardInterrupt)):
        raise error
    text = redact(_without_trace(str(error)))
    seen = "\n".join([type(error).__name__, *map(_without_trace, _causes(error))])
    written = kind != "read"

    def has(marks: list[str]) -> bool:
        return any(m in seen for m in marks)

    if has(DUPLICATE_MARKS):
        return LakeError(DUPLICATE_MATCH, f"{operation}: several incoming rows match one row of the table on ({', '.join(keys or [])})", "make the keys unique in the input")
    if kind == "merge" and predicate and type(error).__name__ in PREDICATE_ERRORS:
        return LakeError(MERGE_PREDICATE, f"{operation}: the merge predicate could not be parsed or computed", "write a comparison of target and source columns")
    if written and has(SHAPE_MARKS):
        return LakeError(SCHEMA_MISMATCH, f"{operation}: stored or incoming columns are not of the types that the table says", "cast the columns, or repair the files")
    if written and has(NULL_MARKS):
        return LakeError(PARTITION_VALUE, f"{operation}: a column that may not be null got a null", "fill the column before writing")
    if written and has(LONG_NAME_MARKS):
        return LakeError(PARTITION_VALUE, f"{operation}: a partition value is too long for a folder's name", "partition by a shorter value")
    if has(UNSAFE_MARKS):
        return LakeError(UNSAFE_STORE, f"{operation}: {text}", "use a store that supports conditional writes")
    if written and has(CONFLICT_MARKS):
        return LakeError(CONFLICT, f"{operation}: another writer changed the table: {text}", "read the table again and repeat the write", transient=True)
    if has(TRANSIENT_MARKS):
        return LakeError(CONFLICT, f"{operation}: the storage did not answer: {text}", "try again", transient=True)
    step = "check the credentials and their rights" if has(DENIED_MARKS) else None
    if written:
        return LakeError(WRITE_FAILED, f"{operation}: {text}", step or "see the message")
    return LakeError(READ_FAILED, f"{operation}: {text}", step or "check that the location holds a table")


def _without_trace(message: str) -> str:
    """A message without the stack that the JVM prints below it, whose class names tell nothing."""
    return "\n".join(x for x in message.splitlines() if not re.match(r"\s*(at [\w.$/]+\(|\.\.\. \d+ more)", x))


def _causes(error: BaseException) -> list[str]:
    """The messages of an error and of what caused it, with the exceptions' names, on the JVM's side too. They tell the kind; only the
    first message is shown."""
    out = [str(error)]
    java = getattr(error, "java_exception", None) or getattr(error, "_origin", None)
    try:
        while java is not None and len(out) < 12:
            out.append(str(java.toString()))
            java = java.getCause()
    except Exception:  # a proxy whose session has gone has no more to say
        pass
    return out + [f"{type(e).__name__}: {e}" for e in (error.__cause__, error.__context__) if e is not None]
