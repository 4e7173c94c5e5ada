"""Session settings for an S3-compatible object store.

Set them when the session is built, so that reads and writes both have them:

    builder = SparkSession.builder
    for key, value in s3a_settings(endpoint, access_key, secret_key).items():
        builder = builder.config(key, value)
"""

from __future__ import annotations


def s3a_settings(
    endpoint: str, access_key: str, secret_key: str, ssl: bool = False
) -> dict[str, str]:
    """Endpoint, credentials and path-style access for ``s3a:`` URIs."""
    return {
        "spark.hadoop.fs.s3a.endpoint": endpoint,
        "spark.hadoop.fs.s3a.access.key": access_key,
        "spark.hadoop.fs.s3a.secret.key": secret_key,
        "spark.hadoop.fs.s3a.connection.ssl.enabled": str(ssl).lower(),
        "spark.hadoop.fs.s3a.path.style.access": "true",
    }


def s3a_path(bucket: str, key: str) -> str:
    return f"s3a://{bucket}/{key.lstrip('/')}"
