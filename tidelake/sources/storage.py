"""Connection options as Hadoop settings, scoped to the bucket or account of the root."""

from __future__ import annotations

import os
from collections.abc import Callable
from urllib.parse import urlsplit

from pyspark.sql import SparkSession

from .. import errors
from . import location


def settings(options: dict, environment: Callable[[str], str | None] = os.environ.get) -> dict[str, str]:
    """Settings of fs.s3a or fs.azure for a connection; none for a local root.

    S3: an endpoint without a scheme gets one by use_ssl; paths are addressed in the url_style; the commit relies on conditional puts, which
    is set and not left to a default. Azure, the first that is complete: connection string, service principal, account key, managed
    identity by client id, managed identity of the account. The last two pass on IDENTITY_ENDPOINT.
    """
    kind = location.classify(options["root"])
    return {location.S3: _s3, location.AZURE: _azure}.get(kind, lambda *_: {})(options, environment)


def _given(options: dict, name: str) -> str | None:
    return options.get(name) or None


def _s3(options: dict, _: Callable) -> dict[str, str]:
    at = f"fs.s3a.bucket.{urlsplit(options['root']).netloc}."
    ssl = options.get("use_ssl", True)
    endpoint = _given(options, "endpoint")
    found = {
        "access.key": _given(options, "access_key_id"), "secret.key": _given(options, "secret_access_key"), "session.token": _given(options, "session_token"), "endpoint.region": _given(options, "region"),
        "endpoint": endpoint and (endpoint if "://" in endpoint else f"{'https' if ssl else 'http'}://{endpoint}"),
        "path.style.access": "true" if options.get("url_style") == "path" else None,
        "connection.ssl.enabled": None if ssl else "false",
        "create.conditional.enabled": "true",
    }
    if found["session.token"]:
        found["aws.credentials.provider"] = "org.apache.hadoop.fs.s3a.TemporaryAWSCredentialsProvider"
    return {at + k: v for k, v in found.items() if v is not None}


def _connection_fields(text: str) -> dict[str, str]:
    fields = {}
    for part in text.split(";"):
        name, _, value = part.partition("=")  # values may hold further equals signs
        if name.strip() and value.strip():
            fields[name.strip().lower()] = value.strip()
    return fields


def _azure(options: dict, environment: Callable) -> dict[str, str]:
    account, tenant, client, secret = (_given(options, k) for k in ("account_name", "tenant_id", "client_id", "client_secret"))
    key, text = _given(options, "account_key"), _given(options, "connection_string")
    sas = endpoint = None
    if text:
        fields = _connection_fields(text)
        account, key, sas, endpoint = (fields.get(k) for k in ("accountname", "accountkey", "sharedaccesssignature", "blobendpoint"))
        tenant = client = secret = None
    if not account:
        return {}
    host = urlsplit(endpoint).netloc if endpoint else f"{account}.dfs.core.windows.net"
    out: dict[str, str | None] = {}
    if not text and tenant and client and secret:
        out |= {"account.auth.type": "OAuth", "account.oauth.provider.type": "org.apache.hadoop.fs.azurebfs.oauth2.ClientCredsTokenProvider", "account.oauth2.client.endpoint": f"https://login.microsoftonline.com/{tenant}/oauth2/token", "account.oauth2.client.id": client, "account.oauth2.client.secret": secret}
    elif key:
        out |= {"account.auth.type": "SharedKey", "account.key": key}
    elif sas:
        out |= {"account.auth.type": "SAS", "sas.fixed.token": sas}
    elif not text and not (client and (tenant or secret)):
        out |= {"account.auth.type": "OAuth", "account.oauth.provider.type": "org.apache.hadoop.fs.azurebfs.oauth2.MsiTokenProvider", "account.oauth2.client.id": client, "account.oauth2.msi.endpoint": environment("IDENTITY_ENDPOINT") or None}
    found = {f"fs.azure.{k}.{host}": v for k, v in out.items() if v}
    if endpoint and endpoint.lower().startswith("http://"):
        found["fs.azure.always.use.https"] = "false"
    return found


def _account(options: dict) -> tuple[str | None, str | None]:
    """The account of a connection, and the blob endpoint if its connection string names one."""
    fields = _connection_fields(_given(options, "connection_string") or "")
    return (fields.get("accountname"), fields.get("blobendpoint")) if fields else (_given(options, "account_name"), None)


def hadoop_uri(place: str, options: dict) -> str:
    """A location in the scheme under which Hadoop opens it: s3a for S3, abfss with the account for Azure.

    Azure locations that name their account (`container@account...`) keep it.
    """
    kind, scheme = location.classify(place), location.scheme_of(place)
    if kind == location.LOCAL:
        return place
    rest = place.split("://", 1)[1]
    if kind == location.S3:
        return f"s3a://{rest}"
    container, slash, path = rest.partition("/")
    account, endpoint = _account(options)
    plain = (endpoint or "").lower().startswith("http://") or scheme == "abfs"
    if "@" not in container:
        if not account:
            raise errors.LakeError(errors.OPTION_MISMATCH, f"an {scheme} location does not name its account", "set 'account_name' or 'connection_string', or write abfss://container@account.dfs.core.windows.net/")
        container += "@" + (urlsplit(endpoint).netloc if endpoint else f"{account}.dfs.core.windows.net")
    return f"{'abfs' if plain else 'abfss'}://{container}{slash}{path}"


def apply(spark: SparkSession, options: dict) -> None:
    """Put a connection's settings into the session's Hadoop configuration."""
    conf = spark._jsc.hadoopConfiguration()
    for k, v in settings(options).items():
        conf.set(k, v)
