"""Resolving links against the address of their page (RFC 3986, section 5)."""

from __future__ import annotations

from urllib.parse import uses_netloc, uses_params, uses_relative

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_SCHEME = r"^([A-Za-z][A-Za-z0-9+.\-]*):"
_AUTHORITY = r"^//([^/?#]*)"
# Root-relative links without empty or dot segments, parameters, query or fragment
# need no parsing: the answer is the page's scheme and host followed by the link.
_PLAIN_ROOT = (
    r"^/(?:(?!\.\.?/)[^/?#;\x00-\x20]+/)*(?:(?!\.\.?\z)[^/?#;\x00-\x20]+)?\z"
)
_PLAIN_BASE = r"^(https?://[A-Za-z0-9._:@\-]+)(?:[/?#].*)?\z"


# Characters whose compatibility form holds one of "/?#@:"; a host
# with one is invalid.
UNSAFE_HOST_CHARS = "⁇⁈⁉℀℁℅℆⩴︓︖﹕﹖﹟﹫＃／：？＠"


def _authority_is_valid(authority: Column) -> Column:
    plain = ~authority.rlike(r"[\[\]]")
    bracketed = authority.rlike(
        r"^(?:[^\[\]]*@)?\[(?:v[0-9A-Fa-f]+\..+|(?=[^\]]*:[^\]]*:)[0-9A-Fa-f:.]+(?:%[^\]]+)?)\](?::.*)?$"
    )
    return (plain | bracketed) & ~authority.rlike(f"[{UNSAFE_HOST_CHARS}]")


def _clean(url: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(url, r"^[\x00-\x20]+", ""), r"[\t\r\n]", "")


def _parts(
    df: DataFrame, url: Column, prefix: str, default_scheme: Column
) -> DataFrame:
    """Adds the components of ``url`` as columns named ``prefix`` + component.

    ``default_scheme`` decides whether an address without a scheme may have
    parameters.
    """
    p = prefix
    df = df.withColumn(f"{p}url", _clean(url))
    df = df.withColumns(
        {
            f"{p}scheme": F.lower(F.regexp_extract(f"{p}url", _SCHEME, 1)),
            f"{p}rest": F.regexp_replace(f"{p}url", _SCHEME, ""),
        }
    )
    df = df.withColumns(
        {
            f"{p}authority": F.regexp_extract(f"{p}rest", _AUTHORITY, 1),
            f"{p}rest": F.regexp_replace(f"{p}rest", _AUTHORITY, ""),
        }
    )
    df = df.withColumns(
        {
            f"{p}fragment": F.regexp_extract(f"{p}rest", r"(?s)^[^#]*#(.*)$", 1),
            f"{p}query": F.regexp_extract(f"{p}rest", r"(?s)^[^#?]*\?([^#]*)", 1),
            f"{p}path": F.regexp_extract(f"{p}rest", r"^[^?#]*", 0),
        }
    )
    scheme = F.when(F.col(f"{p}scheme") != "", F.col(f"{p}scheme")).otherwise(default_scheme)
    has_params = scheme.isin(*uses_params)
    return df.withColumns(
        {
            f"{p}params": F.when(
                has_params, F.regexp_extract(f"{p}path", r"^(?:.*/)?[^/;]*;([^/]*)$", 1)
            ).otherwise(""),
            f"{p}path": F.when(
                has_params, F.regexp_replace(f"{p}path", r";[^/]*$", "")
            ).otherwise(F.col(f"{p}path")),
        }
    )


def _add_path(df: DataFrame, path: str, base_path: str, into: str) -> DataFrame:
    """Adds ``path`` taken relative to the directory of ``base_path``, without dot
    segments. Steps are columns of their own, so none is computed twice."""
    c = F.col
    directory = F.when(c(base_path) == "", F.lit("/")).otherwise(
        F.regexp_replace(base_path, r"[^/]*$", "")
    )
    rooted = c(path).startswith("/")
    df = df.withColumn(
        "_joined",
        F.split(F.when(rooted, c(path)).otherwise(F.concat(directory, path)), "/"),
    )
    inner = F.filter(F.slice("_joined", 2, F.size("_joined") - 2), lambda s: s != "")
    df = df.withColumn(
        "_segments",
        F.when(rooted | (F.size("_joined") <= 2), c("_joined")).otherwise(
            F.concat(F.slice("_joined", 1, 1), inner, F.slice("_joined", -1, 1))
        ),
    )
    kept = F.aggregate(
        "_segments",
        F.array().cast("array<string>"),
        lambda stack, s: F.when(
            s == "..", F.slice(stack, 1, F.greatest(F.size(stack) - 1, F.lit(0)))
        )
        .when(s == ".", stack)
        .otherwise(F.concat(stack, F.array(s))),
    )
    end = F.when(
        F.element_at("_segments", -1).isin(".", ".."), F.array(F.lit(""))
    ).otherwise(F.array().cast("array<string>"))
    df = df.withColumn(into, F.array_join(F.concat(kept, end), "/"))
    return df.withColumn(into, F.when(c(into) == "", F.lit("/")).otherwise(c(into)))


def _assemble(
    scheme: Column,
    authority: Column,
    path: Column,
    query: Column,
    fragment: Column,
) -> Column:
    rooted = F.when(
        (path != "") & ~path.startswith("/"), F.concat(F.lit("/"), path)
    ).otherwise(path)
    slashes = path.startswith("//") | (
        scheme.isin(*[s for s in uses_netloc if s]) & ((path == "") | path.startswith("/"))
    )
    hier = (
        F.when(authority != "", F.concat(F.lit("//"), authority, rooted))
        .when(slashes, F.concat(F.lit("//"), path))
        .otherwise(path)
    )
    return F.concat(
        F.when(scheme != "", F.concat(scheme, F.lit(":"))).otherwise(""),
        hier,
        F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""),
        F.when(fragment != "", F.concat(F.lit("#"), fragment)).otherwise(""),
    )


def resolve_links(df: DataFrame, base: str, link: str, into: str) -> DataFrame:
    """Adds ``into``: the absolute address of ``link`` on page ``base``.

    Gives what ``urllib.parse.urljoin`` gives, without leaving the JVM. Rows with
    an invalid address are left out.
    """
    columns = df.columns
    c = F.col
    df = df.withColumn("_plain", c(link).rlike(_PLAIN_ROOT) & c(base).rlike(_PLAIN_BASE))
    # Plain links leave the components NULL, so none of their regexes run.
    df = _parts(df, F.when(~c("_plain"), c(base)), "_b_", F.lit(""))
    df = _parts(df, F.when(~c("_plain"), c(link)), "_l_", c("_b_scheme"))
    # Early on, since Catalyst inlines all columns that a filter needs.
    df = df.where(
        c("_plain")
        | (c(base) == "")
        | (c(link) == "")
        | (_authority_is_valid(c("_l_authority")) & _authority_is_valid(c("_b_authority")))
    )
    df = _add_path(df, "_l_path", "_b_path", "_path")
    df = df.withColumns(
        {
            "_scheme": F.when(c("_l_scheme") != "", c("_l_scheme")).otherwise(
                c("_b_scheme")
            ),
            # Where the link keeps the page's path: it has none of its own.
            "_same_path": (c("_l_path") == "") & (c("_l_params") == ""),
            "_own_host": c("_l_authority") != "",
        }
    )
    # The link's own host, the page's path and the merged path differ only in
    # which components they take.
    own = c("_scheme").isin(*uses_netloc) & c("_own_host")
    params = F.when(~own & c("_same_path"), c("_b_params")).otherwise(c("_l_params"))
    path = (
        F.when(own, c("_l_path")).when(c("_same_path"), c("_b_path")).otherwise(c("_path"))
    )
    keeps_query = ~own & c("_same_path") & (c("_l_query") == "")
    df = df.withColumns(
        {
            "_host": F.when(own, c("_l_authority")).otherwise(c("_b_authority")),
            "_full_path": F.concat(
                path, F.when(params != "", F.concat(F.lit(";"), params)).otherwise("")
            ),
            "_query": F.when(keeps_query, c("_b_query")).otherwise(c("_l_query")),
        }
    )
    full = (
        F.when(c(base) == "", c(link))
        .when(c(link) == "", c(base))
        .when(
            (c("_scheme") != c("_b_scheme")) | ~c("_scheme").isin(*uses_relative),
            c(link),
        )
        .otherwise(
            _assemble(
                c("_scheme"), c("_host"), c("_full_path"), c("_query"), c("_l_fragment")
            )
        )
    )
    quick = F.concat(F.regexp_extract(base, _PLAIN_BASE, 1), c(link))
    return df.select(*columns, F.when(c("_plain"), quick).otherwise(full).alias(into))
