"""URL columns: splitting, validity, resolving and cleaning.

The ``with_*`` functions take and return a DataFrame. They build their result
in a few projection steps, so each intermediate value is computed once per row
and everything stays in generated code.
"""

from pyspark.sql import Column, DataFrame, functions as F

from newsloom.functions.steps import computed_once
from newsloom.functions.text import WS, remove_control_chars, strip_text

PART_NAMES = ("scheme", "netloc", "path", "params", "query", "fragment")

# Schemes whose last path segment may carry ;parameters, and
# schemes that are written with // even when the host is empty.
PARAM_SCHEMES = (
    "", "ftp", "hdl", "prospero", "http", "imap", "https", "shttp", "rtsp",
    "rtsps", "rtspu", "sip", "sips", "mms", "sftp", "tel",
)
NETLOC_SCHEMES = (
    "", "ftp", "http", "gopher", "nntp", "telnet", "imap", "wais", "file",
    "mms", "https", "shttp", "snews", "prospero", "rtsp", "rtsps", "rtspu",
    "rsync", "svn", "svn+ssh", "sftp", "nfs", "git", "git+ssh", "ws", "wss",
    "itms-services",
)
# Characters whose compatibility form contains / ? # @ or :
DISGUISED_DELIMITERS = (
    r"\x{2047}-\x{2049}\x{2100}\x{2101}\x{2105}\x{2106}\x{2a74}\x{fe13}\x{fe16}"
    r"\x{fe55}\x{fe56}\x{fe5f}\x{fe6b}\x{ff03}\x{ff0f}\x{ff1a}\x{ff1f}\x{ff20}"
)


def _ip_literal_pattern() -> str:
    """Pattern for what may stand in [brackets]: IPv6 (RFC 3986) or IPvFuture."""
    h = "[0-9A-Fa-f]{1,4}"
    octet = "(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
    low32 = f"(?:{h}:{h}|{octet}(?:\\.{octet}){{3}})"
    forms = [f"(?:{h}:){{6}}{low32}"]
    for after in range(5, -1, -1):
        before = f"(?:(?:{h}:){{0,{4 - after}}}{h})?" if after < 5 else ""
        forms.append(f"{before}::(?:{h}:){{{after}}}{low32}")
    forms.append(f"(?:(?:{h}:){{0,5}}{h})?::{h}")
    forms.append(f"(?:(?:{h}:){{0,6}}{h})?::")
    return f"^(?:(?:{'|'.join(forms)})(?:%[^%]+)?|v[0-9A-Fa-f]+\\..+)$"


IP_LITERAL = _ip_literal_pattern()


def invalid_netloc(netloc: Column) -> Column:
    """True where the host part cannot be parsed: odd brackets or letters."""
    opened, closed = F.contains(netloc, F.lit("[")), F.contains(netloc, F.lit("]"))
    bracketed = F.regexp_extract(netloc, r"\[([^\]]*)", 1)
    return (
        (opened != closed)
        | (opened & closed & ~bracketed.rlike(IP_LITERAL))
        | netloc.rlike(f"[{DISGUISED_DELIMITERS}]")
    )


def netloc_of(url: Column) -> Column:
    """Host part of a URL as one expression, for use inside lambdas."""
    return F.regexp_extract(url, r"(?s)^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1)


def with_url_parts(df: DataFrame, url: str, prefix: str = "") -> DataFrame:
    """Add scheme, netloc, path, params, query and fragment of `url`.

    The columns are named `prefix` + part name. A null URL has empty parts.
    """
    return computed_once(_split(df, url, prefix), *(prefix + name for name in PART_NAMES))


def _split(df: DataFrame, url: str, prefix: str) -> DataFrame:
    p = prefix
    rest, head = f"__{p}rest", f"__{p}head"
    leading = "".join(chr(i) for i in range(33))
    text = F.regexp_replace(F.ltrim(F.coalesce(F.col(url), F.lit("")), F.lit(leading)), "[\t\r\n]+", "")
    df = df.withColumn(rest, text)
    df = df.withColumn(head, F.substring_index(rest, "#", 1))
    df = df.withColumns({
        f"{p}fragment": F.substring(F.col(rest), F.length(head) + 2, F.length(rest)),
        f"{p}scheme": F.regexp_extract(head, "^([A-Za-z][A-Za-z0-9+.-]*):", 1),
    })
    df = df.withColumn(
        rest,
        F.when(F.col(f"{p}scheme") == "", F.col(head))
        .otherwise(F.substring(F.col(head), F.length(f"{p}scheme") + 2, F.length(head))),
    )
    df = df.withColumn(head, F.substring_index(rest, "?", 1))
    df = df.withColumns({
        f"{p}query": F.substring(F.col(rest), F.length(head) + 2, F.length(rest)),
        f"{p}scheme": F.lower(f"{p}scheme"),
        f"{p}netloc": F.when(
            F.startswith(F.col(head), F.lit("//")),
            F.substring_index(F.substring(F.col(head), F.lit(3), F.length(head)), "/", 1),
        ).otherwise(F.lit("")),
    })
    df = df.withColumn(
        rest,
        F.when(
            F.startswith(F.col(head), F.lit("//")),
            F.substring(F.col(head), F.length(f"{p}netloc") + 3, F.length(head)),
        ).otherwise(F.col(head)),
    )
    last = F.substring_index(rest, "/", -1)
    df = df.withColumn(
        f"{p}params",
        F.when(
            F.col(f"{p}scheme").isin(*PARAM_SCHEMES) & F.contains(last, F.lit(";")),
            F.substring(last, F.instr(last, ";") + 1, F.length(last)),
        ),
    )
    df = df.withColumns({
        f"{p}path": F.when(
            F.col(f"{p}params").isNotNull(),
            F.left(F.col(rest), F.length(rest) - F.length(f"{p}params") - 1),
        ).otherwise(F.col(rest)),
        f"{p}params": F.coalesce(f"{p}params", F.lit("")),
    })
    return df.drop(rest, head)


def join_url(scheme: Column, netloc: Column, path: Column, params: Column,
             query: Column, fragment: Column) -> Column:
    """Write a URL from its parts; empty parts leave no delimiter behind."""
    def optional(mark: str, part: Column) -> Column:
        return F.when(part != "", F.concat(F.lit(mark), part)).otherwise(F.lit(""))

    local = F.concat(path, optional(";", params))
    slash = F.startswith(local, F.lit("/"))
    place = (
        F.when(
            netloc != "",
            F.concat(F.lit("//"), netloc, F.when((local == "") | slash, F.lit("")).otherwise(F.lit("/")), local),
        )
        .when(F.startswith(local, F.lit("//")), F.concat(F.lit("//"), local))
        .when(
            (scheme != "") & scheme.isin(*NETLOC_SCHEMES) & ((local == "") | slash),
            F.concat(F.lit("//"), local),
        )
        .otherwise(local)
    )
    lead = F.when(scheme != "", F.concat(scheme, F.lit(":"))).otherwise(F.lit(""))
    return F.concat(lead, place, optional("?", query), optional("#", fragment))


def _percent_encode(ascii_text: Column, safe: dict) -> Column:
    """Percent-encode ASCII text without blanks, leaving letters, digits,
    ``-._~`` and the `safe` characters. ``url_encode`` treats ``~`` and ``*``
    the other way round, so these are put right afterwards."""
    out = F.url_encode(ascii_text)
    for code, char in {"%7E": "~", **safe}.items():
        out = F.replace(out, F.lit(code), F.lit(char))
    return F.replace(out, F.lit("*"), F.lit("%2A"))


def _normalized_path(path: Column) -> Column:
    segments = F.filter(F.transform(F.split(path, "/"), strip_text), lambda s: s != "")
    return F.when(F.size(segments) > 0, F.concat(F.lit("/"), F.array_join(segments, "/"))).otherwise(F.lit(""))


def _normalized_query(query: Column) -> Column:
    params = F.filter(F.transform(F.split(query, "&"), strip_text), lambda s: s != "")
    # Blanks around the first = of each parameter go as well.
    tidy = F.transform(params, lambda s: F.regexp_replace(s, f"(?s)^([^=]*?)[{WS}]*=[{WS}]*", "$1="))
    return F.array_join(tidy, "&")


def _check_mode(mode: str) -> None:
    if mode not in ("local", "ci"):
        raise ValueError(f"unknown URL mode: {mode!r}")


def with_clean_url(df: DataFrame, url: str, to: str, mode: str = "local", error: str | None = None) -> DataFrame:
    """Add the cleaned form of `url` as column `to`; null and '' stay as they are.

    mode "local": keep printable ASCII only, turn blanks into hyphens, and
    percent-encode path and query. A URL whose host cannot be parsed keeps its
    form before encoding.

    mode "ci": keep all letters, tidy path segments and query parameters. A URL
    whose host cannot be parsed becomes null.

    `error`, if given, names a boolean column telling of such a host.
    """
    _check_mode(mode)
    tidy, prefix = "__tidy", "__u_"
    part = {name: F.col(prefix + name) for name in PART_NAMES}
    if mode == "local":
        ascii_text = F.trim(F.regexp_replace(url, "[^ -~]+", ""))
        df = df.withColumn(tidy, F.regexp_replace(ascii_text, " +", "-"))
    else:
        df = df.withColumn(tidy, strip_text(remove_control_chars(F.col(url))))
    df = _split(df, tidy, prefix)
    bad = prefix + "bad"
    df = df.withColumn(bad, invalid_netloc(part["netloc"]))
    if mode == "local":
        built = join_url(
            part["scheme"], part["netloc"], _percent_encode(part["path"], {"%2F": "/"}), part["params"],
            _percent_encode(part["query"], {"%3D": "=", "%26": "&"}), part["fragment"],
        )
        clean = F.when(F.col(bad), F.col(tidy)).otherwise(built)
    else:
        built = join_url(
            part["scheme"], strip_text(part["netloc"]), _normalized_path(part["path"]), part["params"],
            _normalized_query(part["query"]), strip_text(part["fragment"]),
        )
        clean = F.when(~F.col(bad), built)
    clean = F.when(F.coalesce(F.col(url), F.lit("")) == "", F.col(url)).otherwise(clean)
    columns = {to: clean}
    if error:
        columns[error] = F.col(bad)
    df = df.withColumns(columns).drop(tidy, bad, *(prefix + name for name in PART_NAMES))
    return computed_once(df, *columns)


def resolve_href(href: Column, base_url: Column) -> Column:
    """Absolute address of `href`. Relative ones are appended to the base as
    they are; ``..``, fragments and other schemes get no special treatment."""
    base_scheme = F.lower(F.regexp_extract(base_url, "^([A-Za-z][A-Za-z0-9+.-]*):", 1))
    return (
        F.when(F.startswith(href, F.lit("http://")) | F.startswith(href, F.lit("https://")), href)
        .when(F.startswith(href, F.lit("//")), F.concat(base_scheme, F.lit(":"), href))
        .otherwise(F.concat(F.rtrim(base_url, F.lit("/")), F.lit("/"), F.ltrim(href, F.lit("/"))))
    )


def with_resolved_href(df: DataFrame, href: str, base_url: str, to: str) -> DataFrame:
    return df.withColumn(to, resolve_href(F.col(href), F.col(base_url)))


def _with_derived(df: DataFrame, url: str, to: str, build) -> DataFrame:
    prefix = "__d_"
    df = _split(df, url, prefix)
    part = {name: F.col(prefix + name) for name in PART_NAMES}
    return computed_once(df.withColumn(to, build(part)).drop(*(prefix + name for name in PART_NAMES)), to)


def with_valid_url(df: DataFrame, url: str, to: str) -> DataFrame:
    """True where the URL has both a scheme and a (parsable) host."""
    return _with_derived(df, url, to, lambda p: (p["scheme"] != "") & (p["netloc"] != "") & ~invalid_netloc(p["netloc"]))


def with_source_domain(df: DataFrame, url: str, to: str) -> DataFrame:
    """Host (and port) without any ``www.``; '' when there is none."""
    return _with_derived(
        df, url, to,
        lambda p: F.when(invalid_netloc(p["netloc"]), F.lit(""))
        .otherwise(F.replace(p["netloc"], F.lit("www."), F.lit(""))),
    )


def with_href_path(df: DataFrame, url: str, to: str) -> DataFrame:
    """Path of the URL; '' when there is none."""
    return _with_derived(
        df, url, to, lambda p: F.when(invalid_netloc(p["netloc"]), F.lit("")).otherwise(p["path"])
    )
