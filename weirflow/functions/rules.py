"""Client rules as column expressions: types, statuses, owners, classes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from weirflow.functions import fixed


def first_match(rules: Sequence[tuple[Column, Column]], default: Column) -> Column:
    """CASE over ordered (condition, value) rules."""
    out = None
    for condition, value in rules:
        out = F.when(condition, value) if out is None else out.when(condition, value)
    return default if out is None else out.otherwise(default)


def by_lookup(c: Column, table: Mapping[str, str], default: Column | None = None) -> Column:
    rules = [(c == F.lit(k), F.lit(v)) for k, v in table.items()]
    return first_match(rules, F.lit(None).cast("string") if default is None else default)


def by_like(c: Column, patterns: Sequence[tuple[str, str]], default: Column) -> Column:
    return first_match([(c.like(p), F.lit(v)) for p, v in patterns], default)


# --- routing ---------------------------------------------------------------------------------


def route_clients(
    df: DataFrame,
    branches: Mapping[str, Mapping[str, Column]],
    client_col: str = "client",
) -> DataFrame:
    """One pass over all clients: each client's own expressions, unknown clients dropped.

    ``branches`` maps a client (any case) to ``{column: expression}``.  A column a branch does
    not set keeps its value, or is null where it does not exist yet.
    """
    client = F.lower(F.col(client_col))
    names = [n.lower() for n in branches]
    columns: list[str] = []
    for exprs in branches.values():
        columns += [c for c in exprs if c not in columns]
    routed = {}
    for name in columns:
        keep = F.col(name) if name in df.columns else F.lit(None)
        rules = [(client == n.lower(), e[name]) for n, e in branches.items() if name in e]
        routed[name] = first_match(rules, keep)
    return df.filter(client.isin(names)).withColumns(routed)


def merge_branches(*branches: DataFrame) -> DataFrame:
    """Flatten branches by column name; a column missing in one is null there."""
    out = branches[0]
    for branch in branches[1:]:
        out = out.unionByName(branch, allowMissingColumns=True)
    return out


# --- users -----------------------------------------------------------------------------------


def has_user_type(raw: Column) -> Column:
    return raw.isNotNull() & (raw != "")


def user_type(raw: Column, on_unknown: str = "raise") -> Column:
    """Raw type -> Distributor or Autoship.  ``on_unknown``: raise, or null (quarantine)."""
    low = F.lower(raw)
    unknown = (
        F.raise_error(F.concat(F.lit("client type not in list: "), low)).cast("string")
        if on_unknown == "raise"
        else F.lit(None).cast("string")
    )
    contains = [(low.contains(text), F.lit(kind)) for text, kind in fixed.USER_TYPE_CONTAINS]
    listed = [(low == k, F.lit(v)) for k, v in fixed.USER_TYPE_LOOKUP.items()]
    return first_match([(raw.isNull(), F.lit(None).cast("string")), *contains, *listed], unknown)


def normalize_user_type(
    df: DataFrame, in_col: str = "client_type", out_col: str = "type", on_unknown: str = "raise"
) -> DataFrame:
    """Rows without a raw type are dropped, the rest get ``out_col``."""
    return df.filter(has_user_type(F.col(in_col))).withColumn(
        out_col, user_type(F.col(in_col), on_unknown)
    )


def user_status(raw: Column, current: Column | None = None) -> Column:
    """Active for active, grace or hold; Inactive for any other text; null keeps ``current``."""
    keep = F.lit(None).cast("string") if current is None else current
    return (
        F.when(raw.isNull(), keep)
        .when(F.lower(raw).isin(fixed.ACTIVE_USER_STATUSES), "Active")
        .otherwise("Inactive")
    )


def member_user_type(code: Column) -> Column:
    """User types of clients that send MEMBER, RETAIL, BA and PC; other codes are null."""
    return by_lookup(code, fixed.MEMBER_TYPE_CODES)


def staged_user_type(raw: Column) -> Column:
    """The case-sensitive rule of the hand-run load; unlisted text is null."""
    listed = [(raw.like(pattern) | raw.isin(types), F.lit(kind)) for pattern, types, kind in fixed.STAGED_USER_TYPES]
    return first_match(listed, F.lit(None).cast("string"))


def active_distributors(
    df: DataFrame, type_col: str = "client_type", status_col: str = "client_status"
) -> DataFrame:
    """Active or grace distributors, without the two helper columns."""
    keep = (F.lower(F.col(type_col)) == "distributor") & F.lower(F.col(status_col)).isin(
        "active", "grace"
    )
    return df.filter(keep).drop(type_col, status_col)


# --- orders ----------------------------------------------------------------------------------


def order_type(user_type_col: Column, coded: Column, order_date: Column) -> Column:
    """Wholesale for a distributor from the sign-up on, Autoship before it and for autoship
    buyers; any other user type is kept, and a distributor without dates keeps its type."""
    kind = F.lower(user_type_col)
    return (
        F.when((kind == "distributor") & (coded <= order_date), "Wholesale")
        .when((kind == "distributor") & (coded > order_date), "Autoship")
        .when(kind == "autoship", "Autoship")
        .otherwise(user_type_col)
    )


def staged_order_type(user_type_col: Column, coded: Column, order_date: Column) -> Column:
    """The hand-run load's rule: as above, with Retail for customers and null otherwise."""
    return (
        F.when((user_type_col == "Distributor") & (coded <= order_date), "Wholesale")
        .when((user_type_col == "Distributor") & (coded > order_date), "Autoship")
        .when(user_type_col == "Customer", "Retail")
        .when(user_type_col == "Autoship", "Autoship")
    )


def order_status(raw: Column, current: Column | None = None) -> Column:
    keep = F.lit(None).cast("string") if current is None else current
    return (
        F.when(raw.isNull(), keep)
        .when(F.lower(raw).isin(fixed.INACTIVE_ORDER_STATUSES), "Inactive")
        .otherwise("Active")
    )


def commission_owner(
    user_type_col: Column,
    buyer: Column,
    sponsor: Column,
    coded: Column,
    order_date: Column,
    legacy: bool = False,
) -> Column:
    """The buyer where a distributor ordered after signing up, else the sponsor.

    ``legacy`` is the composed job's effect: it tested the *order* type, which is never
    Distributor any more at that point, so the sponsor always owned the order.
    """
    if legacy:
        return sponsor
    return (
        F.when(user_type_col != "Distributor", sponsor)
        .when((user_type_col == "Distributor") & (coded > order_date), sponsor)
        .when(user_type_col == "Distributor", buyer)
    )


def order_code_name(code: Column) -> Column:
    return by_lookup(code, fixed.ORDER_CODE_NAMES)


def is_autoship(template_id: Column) -> Column:
    """A flag from a number; null and non-positive are false."""
    return F.coalesce(template_id > 0, F.lit(False))


# --- products, logins, people ----------------------------------------------------------------


def product_type(text: Column) -> Column:
    return by_like(F.lower(text), fixed.PRODUCT_TYPE_PATTERNS, text)


def membership_type(text: Column) -> Column:
    return by_like(F.lower(text), fixed.MEMBERSHIP_PATTERNS, F.lit("none"))


def is_college(text: Column) -> Column:
    return F.coalesce(F.lower(text).like("%college%"), F.lit(False))


def platform_class(platform: Column) -> Column:
    known = by_like(platform, fixed.PLATFORM_PATTERNS, F.lit("other"))
    return F.when(platform.isNull(), "unknown").otherwise(known)


def _bucket(days: Column, edges, pick: int) -> Column:
    out = None
    for low, high, *labels in edges:
        inside = days >= low if high is None else days.between(low, high)
        value = F.lit(labels[pick])
        out = F.when(inside, value) if out is None else out.when(inside, value)
    return out


def day_bucket(days: Column, edges=fixed.DAY_BUCKETS) -> Column:
    """Bucket label; negative and null days have none."""
    return _bucket(days, edges, 0)


def day_bucket_rank(days: Column, edges=fixed.DAY_BUCKETS) -> Column:
    return _bucket(days, edges, 1)


def gender(c: Column) -> Column:
    return F.when(c.isin("F", "female"), "female").when(c.isin("M", "male"), "male").otherwise("none")


def street(address1: Column, address2: Column) -> Column:
    """address1, then a space and address2 where there is one; null address1 gives null."""
    second = F.when(address2.isNotNull() & (address2 != ""), F.concat(F.lit(" "), address2))
    return F.concat(address1, F.coalesce(second, F.lit("")))


def without_test_titles(df: DataFrame, title_col: str) -> DataFrame:
    """Drop titles holding 'test'; null titles go too."""
    return df.filter(~F.col(title_col).like("%test%"))


# --- lists, paths, posted records ------------------------------------------------------------


def parse_id_list(text: Column) -> Column:
    """'3,1,,3' -> [3, 1]: blanks ignored, repeats dropped, order kept."""
    parts = F.filter(F.split(text, ","), lambda p: p != "")
    return F.transform(F.array_distinct(parts), lambda p: p.cast("long"))


def is_id_list(text: Column) -> Column:
    return ~text.rlike("[^0-9,]")


def in_id_list(df: DataFrame, key: str, id_lists: DataFrame, list_col: str) -> DataFrame:
    """Rows whose key is named in any list: a semi join on the parsed ids."""
    ids = id_lists.filter(is_id_list(F.col(list_col))).select(
        F.explode(parse_id_list(F.col(list_col))).alias(key)
    )
    return df.join(ids.distinct(), key, "left_semi")


def log_date(path: Column) -> Column:
    """The first date of a dated log path, null for any other path."""
    found = F.regexp_extract(path, fixed.LOG_DATE_PATTERN, 1)
    return F.when(path.rlike(fixed.LOG_PATH_PATTERN), found.try_cast("date"))


def expired_paths(df: DataFrame, path_col: str, as_of: Column, days: int) -> DataFrame:
    """Log paths dated ``days`` or more before ``as_of``."""
    return df.filter(log_date(F.col(path_col)) <= F.date_sub(F.to_date(as_of), days))


def require_fields(df: DataFrame, fields: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(valid rows, rejected rows with the names of the missing fields)."""
    missing = F.filter(
        F.array(*[F.when(F.col(f).isNull(), F.lit(f)) for f in fields]), lambda m: m.isNotNull()
    )
    marked = df.withColumn("missing_fields", missing)
    return (
        marked.filter(F.size("missing_fields") == 0).drop("missing_fields"),
        marked.filter(F.size("missing_fields") > 0),
    )
