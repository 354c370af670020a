"""Where data lives and how it is compressed.

Spark reaches every store through Hadoop file system URIs; this module turns
store options into ``spark.hadoop.*`` settings and codec names into what each
format calls them.
"""

from __future__ import annotations

import urllib.parse
from collections.abc import Mapping
from typing import Any

from pyspark.sql import SparkSession

from millrace.config import enum, section
from millrace.errors import ConfigError

# Names of stores and codecs, and file name suffixes of codecs.
FILE_SYSTEMS = ("AUTO", "LOCAL", "S3", "GCS", "HDFS")
CODECS = ("AUTO", "UNCOMPRESSED", "SNAPPY", "GZIP", "BROTLI", "ZSTD", "LZ4", "LZ4_FRAME", "LZO", "BZ2")
SUFFIX_CODECS = {
    ".gz": "GZIP",
    ".bz2": "BZ2",
    ".zst": "ZSTD",
    ".lz4": "LZ4_FRAME",
    ".br": "BROTLI",
    ".snappy": "SNAPPY",
}
# Codecs Spark's text readers decode by themselves when the suffix says so.
NATIVE_READ_SUFFIX = {"GZIP": ".gz", "BZ2": ".bz2", "ZSTD": ".zst"}
# Codecs that can be used as a byte stream, under their PyArrow names.
STREAM_CODECS = {"GZIP": "gzip", "BZ2": "bz2", "ZSTD": "zstd", "LZ4_FRAME": "lz4", "BROTLI": "brotli"}

_PARQUET_CODECS = {
    "AUTO": "uncompressed",
    "UNCOMPRESSED": "uncompressed",
    "SNAPPY": "snappy",
    "GZIP": "gzip",
    "ZSTD": "zstd",
    "LZ4": "lz4_raw",
}
_ORC_CODECS = {
    "AUTO": "none",
    "UNCOMPRESSED": "none",
    "SNAPPY": "snappy",
    "GZIP": "zlib",
    "ZSTD": "zstd",
    "LZ4": "lz4",
    "LZO": "lzo",
}
_SCHEMES = {"S3": ("s3a", "s3", "s3n"), "GCS": ("gs",), "HDFS": ("hdfs",)}
_COMMON_FIELDS = {"filesystem": "AUTO", "compression": "AUTO", "filesystem_options": {}}

S3_CREDENTIALS = ("ANONYMOUS", "DEFAULT", "EXPLICIT", "ROLE", "WEB_IDENTITY")
AZURE_CREDENTIALS = (
    "DEFAULT", "ANONYMOUS", "STORAGE_SHARED_KEY", "SAS_TOKEN", "CLIENT_SECRET",
    "MANAGED_IDENTITY", "CLI", "WORKLOAD_IDENTITY", "ENVIRONMENT",
)


OUTPUT_TYPES = ("TABLE", "RECORD_BATCH")


def output_type(step: str, cfg: Mapping[str, Any]) -> str:
    """Whether a source's Arrow payloads hold whole tables or single batches."""
    return enum(step, cfg["output_type"], "OUTPUT_TYPE_", OUTPUT_TYPES)


def common_section(step: str, common: Mapping[str, Any] | None) -> dict[str, Any]:
    fields = section(step, common, _COMMON_FIELDS)
    fields["filesystem"] = enum(step, fields["filesystem"], "FILE_SYSTEM_", FILE_SYSTEMS)
    fields["compression"] = enum(step, fields["compression"], "COMPRESSION_", CODECS)
    return fields


def resolve_path(path: str, common: Mapping[str, Any]) -> tuple[str, dict[str, str]]:
    """Path and Hadoop settings for a store selection.

    LOCAL returns at once and ignores the options. Otherwise given options win,
    then the URI decides; AUTO also takes a plain path.
    """
    store = common["filesystem"]
    if store == "LOCAL":
        return ("file://" + path if path.startswith("/") else path), {}
    options = common["filesystem_options"]
    if len(options) > 1:
        raise ConfigError("filesystem_options takes one of s3, gcs, azure, hdfs")
    scheme = urllib.parse.urlparse(path).scheme
    if options:
        kind, values = next(iter(options.items()))
        builders = {"s3": _s3_settings, "gcs": _gcs_settings, "azure": _azure_settings, "hdfs": _hdfs_settings}
        if kind not in builders:
            raise ConfigError(f"unknown filesystem_options entry {kind}")
        if not scheme:
            raise ConfigError(f"{kind} options need a URI, got the plain path {path}")
        return _spark_uri(path), builders[kind](values)
    if store != "AUTO":
        if scheme not in _SCHEMES[store]:
            raise ConfigError(f"{store.lower()} needs a URI of scheme {_SCHEMES[store][0]}, got {path}")
    return _spark_uri(path), {}


def use_storage(spark: SparkSession, path: str, common: Mapping[str, Any]) -> str:
    """Resolve a path and give the session its store settings."""
    resolved, settings = resolve_path(path, common)
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    for name, value in settings.items():
        hadoop.set(name, value)
    return resolved


def qualified(spark: SparkSession, path: str) -> str:
    """The path as a full URI, so that tasks find it without Hadoop's defaults."""
    context = spark.sparkContext
    hadoop_path = context._jvm.org.apache.hadoop.fs.Path(path)
    filesystem = hadoop_path.getFileSystem(context._jsc.hadoopConfiguration())
    return filesystem.makeQualified(hadoop_path).toString()


def resolve_codec(path: str, codec: str) -> str:
    """An explicit codec, or the one the suffix names, or none."""
    if codec != "AUTO":
        return codec
    for suffix, name in SUFFIX_CODECS.items():
        if path.endswith(suffix):
            return name
    return "UNCOMPRESSED"


def stream_codec(step: str, codec: str) -> str:
    """PyArrow name of a codec that works on byte streams."""
    if codec not in STREAM_CODECS:
        raise ConfigError(f"{step}: codec {codec.lower()} cannot be used on a byte stream")
    return STREAM_CODECS[codec]


def parquet_codec(codec: str) -> str:
    if codec not in _PARQUET_CODECS:
        raise ConfigError(f"Parquet files cannot be written with codec {codec.lower()}")
    return _PARQUET_CODECS[codec]


def orc_codec(codec: str) -> str:
    if codec not in _ORC_CODECS:
        raise ConfigError(f"ORC files cannot be written with codec {codec.lower()}")
    return _ORC_CODECS[codec]


#: Stores that tasks can open through Arrow.
ARROW_SCHEMES = ("", "file", "s3", "s3a", "s3n", "gs", "gcs", "abfs", "abfss", "hdfs", "viewfs")


def arrow_store(path: str, common: Mapping[str, Any]) -> dict[str, Any] | None:
    """Store options for the file systems that tasks open, as plain values: the checked counterpart of
    :func:`resolve_path`. None where nothing is set, so that the URI decides."""
    options = common["filesystem_options"]
    if common["filesystem"] == "LOCAL" or not options:
        return None
    resolve_path(path, common)
    kind, values = next(iter(options.items()))
    builders = {"s3": _arrow_s3, "gcs": _arrow_gcs, "azure": _arrow_azure, "hdfs": _arrow_hdfs}
    return {"kind": kind, **{name: value for name, value in builders[kind](values).items() if value not in (None, "", {}, [])}}


def arrow_reads(path: str) -> bool:
    return urllib.parse.urlparse(path).scheme in ARROW_SCHEMES


def arrow_filesystem(uri: str, store: Mapping[str, Any] | None = None):
    """A PyArrow file system for use inside tasks, and the path on it. ``store``: what :func:`arrow_store` gave."""
    from pyarrow import fs

    parsed = urllib.parse.urlparse(uri)
    if not parsed.scheme:
        return fs.LocalFileSystem(), uri
    if parsed.scheme == "file":
        return fs.LocalFileSystem(), urllib.parse.unquote(parsed.path)
    if store:
        kind = store["kind"]
        kinds = {"s3": "S3FileSystem", "gcs": "GcsFileSystem", "azure": "AzureFileSystem", "hdfs": "HadoopFileSystem"}
        settings = {name: value for name, value in store.items() if name != "kind"}
        if kind == "hdfs":
            settings.setdefault("host", parsed.hostname or "default")
            return fs.HadoopFileSystem(**settings), parsed.path
        place = urllib.parse.unquote(parsed.netloc.rpartition("@")[0] or parsed.netloc) + urllib.parse.unquote(parsed.path)
        return getattr(fs, kinds[kind])(**settings), place
    if parsed.scheme in ("s3a", "s3n"):
        uri = "s3" + uri[len(parsed.scheme):]
    return fs.FileSystem.from_uri(uri)


def _arrow_s3(values: Mapping[str, Any]) -> dict[str, Any]:
    kind = enum("filesystem_options.s3", values.get("credentials_kind", "DEFAULT"), "S3_CREDENTIALS_KIND_", S3_CREDENTIALS)
    proxy = {name: value for name, value in (values.get("proxy_options") or {}).items() if value not in (None, "")}
    same = (
        "region", "connect_timeout", "request_timeout", "endpoint_override", "scheme", "force_virtual_addressing", "background_writes",
        "allow_bucket_creation", "allow_bucket_deletion", "check_directory_existence_before_creation", "allow_delayed_open", "default_metadata",
    )
    out = {name: values.get(name) for name in same} | {"anonymous": True if kind == "ANONYMOUS" else None, "proxy_options": proxy}
    if kind == "EXPLICIT":
        out |= {name: values.get(name) for name in ("access_key", "secret_key", "session_token")}
    elif kind == "ROLE":
        out |= {name: values.get(name) for name in ("role_arn", "session_name", "external_id", "load_frequency")}
    if values.get("sse_customer_key"):
        raise ConfigError("sse_customer_key has no effect where tasks open S3 files themselves")
    return out


def _arrow_gcs(values: Mapping[str, Any]) -> dict[str, Any]:
    cred = values.get("credentials") or {}
    if cred.get("json_credentials"):
        raise ConfigError("json_credentials have no effect where tasks open GCS files themselves; use the nodes' default credentials")
    same = ("endpoint_override", "scheme", "default_bucket_location", "default_metadata", "project_id")
    out = {name: values.get(name) for name in same}
    out |= {"anonymous": cred.get("anonymous") or None, "target_service_account": cred.get("target_service_account")}
    if values.get("retry_limit_seconds"):
        from datetime import timedelta

        out["retry_time_limit"] = timedelta(seconds=values["retry_limit_seconds"])
    return out


def _arrow_azure(values: Mapping[str, Any]) -> dict[str, Any]:
    cred = values.get("credentials") or {}
    kind = enum("filesystem_options.azure.credentials", cred.get("kind", "DEFAULT"), "AZURE_CREDENTIAL_KIND_", AZURE_CREDENTIALS)
    same = ("account_name", "blob_storage_authority", "dfs_storage_authority", "blob_storage_scheme", "dfs_storage_scheme")
    out = {name: values.get(name) for name in same}
    if kind == "STORAGE_SHARED_KEY":
        out["account_key"] = cred["storage_shared_key"]
    elif kind == "SAS_TOKEN":
        out["sas_token"] = cred["sas_token"]
    elif kind == "CLIENT_SECRET":
        out |= {name: cred[name] for name in ("tenant_id", "client_id", "client_secret")}
    elif kind in ("MANAGED_IDENTITY", "WORKLOAD_IDENTITY"):
        out["client_id"] = cred.get("client_id")
    return out


def _arrow_hdfs(values: Mapping[str, Any]) -> dict[str, Any]:
    conn = values.get("connection_config") or {}
    out = {name: conn.get(name) for name in ("host", "port", "user", "kerb_ticket", "extra_conf")}
    return out | {name: values.get(name) for name in ("buffer_size", "replication", "default_block_size")}


def _spark_uri(path: str) -> str:
    for scheme in ("s3://", "s3n://"):
        if path.startswith(scheme):
            return "s3a://" + path[len(scheme):]
    return path


def _settings(pairs) -> dict[str, str]:
    """Keep what is set: an absent or zero-like option means the default."""
    out = {}
    for name, value in pairs:
        if value in (None, "", {}, []):
            continue
        out[name] = str(value).lower() if isinstance(value, bool) else str(value)
    return out


def _refuse(store: str, values: Mapping[str, Any], *names: str) -> None:
    """Options that no client here can use are an error, not a silent loss."""
    for name in names:
        if values[name] not in (None, False, "", {}, []):
            raise ConfigError(f"filesystem_options.{store}.{name} has no effect in Spark's client of this store")


def _s3_settings(values: Mapping[str, Any]) -> dict[str, str]:
    known = {
        "smart_defaults": "", "region": "", "connect_timeout": None, "request_timeout": None,
        "endpoint_override": "", "scheme": "", "role_arn": "", "session_name": "", "external_id": "",
        "load_frequency": None, "proxy_options": {}, "credentials_kind": "DEFAULT",
        "force_virtual_addressing": None, "background_writes": None, "allow_bucket_creation": None,
        "allow_bucket_deletion": None, "check_directory_existence_before_creation": None,
        "allow_delayed_open": None, "default_metadata": {}, "sse_customer_key": "",
        "tls_ca_file_path": "", "tls_ca_dir_path": "", "tls_verify_certificates": None,
        "access_key": "", "secret_key": "", "session_token": "",
    }
    v = section("filesystem_options.s3", values, known)
    kind = enum("filesystem_options.s3", v["credentials_kind"], "S3_CREDENTIALS_KIND_", S3_CREDENTIALS)
    _refuse("s3", v, "smart_defaults", "allow_bucket_creation", "allow_bucket_deletion")
    proxy = section(
        "filesystem_options.s3.proxy_options",
        v["proxy_options"],
        {"scheme": "", "host": "", "port": None, "username": "", "password": ""},
    )
    seconds = lambda value: None if value is None or value < 0 else f"{int(value * 1000)}ms"
    providers = {
        "ANONYMOUS": "org.apache.hadoop.fs.s3a.AnonymousAWSCredentialsProvider",
        "EXPLICIT": "org.apache.hadoop.fs.s3a.SimpleAWSCredentialsProvider",
        "ROLE": "org.apache.hadoop.fs.s3a.auth.AssumedRoleCredentialProvider",
        "WEB_IDENTITY": "software.amazon.awssdk.auth.credentials.WebIdentityTokenFileCredentialsProvider",
    }
    provider = providers.get(kind)
    if kind == "EXPLICIT":
        if not (v["access_key"] and v["secret_key"]):
            raise ConfigError("explicit S3 credentials need access_key and secret_key")
        if v["session_token"]:
            provider = "org.apache.hadoop.fs.s3a.TemporaryAWSCredentialsProvider"
    if kind == "ROLE" and not v["role_arn"]:
        raise ConfigError("S3 role credentials need role_arn")
    path_style = None
    if v["endpoint_override"] and v["force_virtual_addressing"] is not None:
        path_style = not v["force_virtual_addressing"]
    elif v["endpoint_override"]:
        path_style = True
    pairs = [
        ("fs.s3a.endpoint.region", v["region"]),
        ("fs.s3a.connection.establish.timeout", seconds(v["connect_timeout"])),
        ("fs.s3a.connection.timeout", seconds(v["request_timeout"])),
        ("fs.s3a.endpoint", v["endpoint_override"]),
        ("fs.s3a.connection.ssl.enabled", None if not v["scheme"] else v["scheme"] == "https"),
        ("fs.s3a.aws.credentials.provider", provider),
        ("fs.s3a.access.key", v["access_key"]),
        ("fs.s3a.secret.key", v["secret_key"]),
        ("fs.s3a.session.token", v["session_token"]),
        ("fs.s3a.assumed.role.arn", v["role_arn"]),
        ("fs.s3a.assumed.role.session.name", v["session_name"]),
        ("fs.s3a.assumed.role.external.id", v["external_id"]),
        ("fs.s3a.assumed.role.session.duration", f"{v['load_frequency']}s" if v["load_frequency"] else None),
        ("fs.s3a.proxy.host", proxy["host"]),
        ("fs.s3a.proxy.port", proxy["port"]),
        ("fs.s3a.proxy.username", proxy["username"]),
        ("fs.s3a.proxy.password", proxy["password"]),
        ("fs.s3a.proxy.ssl.enabled", None if not proxy["scheme"] else proxy["scheme"] == "https"),
        ("fs.s3a.path.style.access", path_style),
        ("fs.s3a.encryption.algorithm", "SSE-C" if v["sse_customer_key"] else None),
        ("fs.s3a.encryption.key", v["sse_customer_key"]),
    ]
    pairs += [(f"fs.s3a.create.header.{name}", value) for name, value in v["default_metadata"].items()]
    if v["tls_verify_certificates"] is False or v["tls_ca_file_path"] or v["tls_ca_dir_path"]:
        raise ConfigError("S3 TLS trust is set in the JVM trust store (javax.net.ssl.trustStore), not per path")
    return _settings(pairs)


def _gcs_settings(values: Mapping[str, Any]) -> dict[str, str]:
    known = {
        "credentials": {}, "endpoint_override": "", "scheme": "", "default_bucket_location": "",
        "retry_limit_seconds": None, "default_metadata": {}, "project_id": "",
    }
    v = section("filesystem_options.gcs", values, known)
    _refuse("gcs", v, "default_bucket_location", "default_metadata")
    cred = section(
        "filesystem_options.gcs.credentials",
        v["credentials"],
        {"anonymous": False, "access_token": "", "expiration": None, "target_service_account": "", "json_credentials": ""},
    )
    _refuse("gcs.credentials", cred, "expiration")
    pairs = []
    if cred["anonymous"]:
        pairs.append(("fs.gs.auth.type", "UNAUTHENTICATED"))
    elif cred["json_credentials"]:
        import json

        key = json.loads(cred["json_credentials"])
        pairs += [
            ("fs.gs.auth.type", "SERVICE_ACCOUNT_JSON_KEYFILE"),
            ("fs.gs.auth.service.account.email", key.get("client_email")),
            ("fs.gs.auth.service.account.private.key.id", key.get("private_key_id")),
            ("fs.gs.auth.service.account.private.key", key.get("private_key")),
        ]
    elif cred["access_token"]:
        raise ConfigError("GCS access tokens need an access token provider class on the cluster")
    endpoint = v["endpoint_override"]
    if endpoint and "://" not in endpoint:
        endpoint = f"{v['scheme'] or 'https'}://{endpoint}"
    pairs += [
        ("fs.gs.auth.impersonation.service.account", cred["target_service_account"]),
        ("fs.gs.storage.root.url", endpoint),
        ("fs.gs.project.id", v["project_id"]),
        ("fs.gs.http.read-timeout", int(v["retry_limit_seconds"] * 1000) if v["retry_limit_seconds"] else None),
    ]
    return _settings(pairs)


def _azure_settings(values: Mapping[str, Any]) -> dict[str, str]:
    known = {
        "account_name": "", "blob_storage_authority": ".blob.core.windows.net",
        "dfs_storage_authority": ".dfs.core.windows.net", "blob_storage_scheme": "https",
        "dfs_storage_scheme": "https", "credentials": {}, "default_metadata": {}, "background_writes": None,
    }
    v = section("filesystem_options.azure", values, known)
    if not v["account_name"]:
        raise ConfigError("azure options need account_name")
    _refuse("azure", v, "default_metadata")
    cred = section(
        "filesystem_options.azure.credentials",
        v["credentials"],
        {"kind": "DEFAULT", "storage_shared_key": "", "sas_token": "", "tenant_id": "", "client_id": "", "client_secret": ""},
    )
    kind = enum("filesystem_options.azure.credentials", cred["kind"], "AZURE_CREDENTIAL_KIND_", AZURE_CREDENTIALS)
    host = v["dfs_storage_authority"]
    account = f"{v['account_name']}{host}" if host.startswith(".") else host
    oauth = "org.apache.hadoop.fs.azurebfs.oauth2."

    def need(*names):
        for name in names:
            if not cred[name]:
                raise ConfigError(f"azure {kind.lower()} credentials need {name}")

    if kind == "STORAGE_SHARED_KEY":
        need("storage_shared_key")
        pairs = [("auth.type", "SharedKey"), ("key", cred["storage_shared_key"])]
    elif kind == "SAS_TOKEN":
        need("sas_token")
        pairs = [("auth.type", "SAS"), ("sas.fixed.token", cred["sas_token"])]
    elif kind == "CLIENT_SECRET":
        need("tenant_id", "client_id", "client_secret")
        pairs = [
            ("auth.type", "OAuth"),
            ("oauth.provider.type", oauth + "ClientCredsTokenProvider"),
            ("oauth2.client.endpoint", f"https://login.microsoftonline.com/{cred['tenant_id']}/oauth2/token"),
            ("oauth2.client.id", cred["client_id"]),
            ("oauth2.client.secret", cred["client_secret"]),
        ]
    elif kind in ("MANAGED_IDENTITY", "DEFAULT"):
        pairs = [
            ("auth.type", "OAuth"),
            ("oauth.provider.type", oauth + "MsiTokenProvider"),
            ("oauth2.client.id", cred["client_id"]),
        ]
    elif kind == "WORKLOAD_IDENTITY":
        pairs = [
            ("auth.type", "OAuth"),
            ("oauth.provider.type", oauth + "WorkloadIdentityTokenProvider"),
            ("oauth2.msi.tenant", cred["tenant_id"]),
            ("oauth2.client.id", cred["client_id"]),
        ]
    else:
        raise ConfigError(f"azure {kind.lower()} credentials are not available through Hadoop")
    secure = ("fs.azure.always.use.https", v["dfs_storage_scheme"] == "https")
    named = [(f"fs.azure.account.{name}.{account}" if name in ("auth.type", "key") or name.startswith("oauth")
              else f"fs.azure.{name}.{account}", value) for name, value in pairs]
    return _settings([*named, secure])


def _hdfs_settings(values: Mapping[str, Any]) -> dict[str, str]:
    known = {"connection_config": {}, "buffer_size": None, "replication": None, "default_block_size": None}
    v = section("filesystem_options.hdfs", values, known)
    conn = section(
        "filesystem_options.hdfs.connection_config",
        v["connection_config"],
        {"host": "", "port": None, "user": "", "kerb_ticket": "", "extra_conf": {}},
    )
    host = conn["host"]
    pairs = [
        ("fs.defaultFS", f"hdfs://{host}:{conn['port']}" if host and conn["port"] else host and f"hdfs://{host}"),
        ("hadoop.job.ugi", conn["user"]),
        ("hadoop.security.kerberos.ticket.cache.path", conn["kerb_ticket"]),
        ("io.file.buffer.size", v["buffer_size"] or None),
        ("dfs.replication", v["replication"] or None),
        ("dfs.blocksize", v["default_block_size"] or None),
    ]
    return _settings(pairs) | {name: str(value) for name, value in conn["extra_conf"].items()}
