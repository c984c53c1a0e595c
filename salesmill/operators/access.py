"""Row-level security: who may see which territories, and views limited to them.

A user's queries run over *secured* views: every protected source is filtered
before it is registered, so joins, unions, subqueries and aggregates over it are
filtered too. Unknown roles and unknown views are refused.
"""

from __future__ import annotations

import dataclasses
import re
import uuid
from collections.abc import Collection, Mapping

from pyspark.errors import ParseException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import mail_key, mail_path_element
from ..session import broadcast_if_small
from .filters import members, not_blank
from .records import unpivot

# Hierarchy levels that carry an address, bottom up.
MAIL_LEVELS = ("sh_2_email", "sh_3_email", "sh_4_email", "sh_5_email", "sh_6_email", "sh_7_email")
HIERARCHY_KIND = "%Sales Hierarchy%"


#: Parts of a stored view, by a hash of the territory, and the column that numbers them.
PARTS = 64
PART = "territory_part"


def part_of(territory: str) -> Column:
    """Number of the part that holds a territory; rows without one are in part -1."""
    hashed = F.pmod(F.xxhash64(F.col(territory).cast("string")), F.lit(PARTS))
    return F.when(F.col(territory).isNull(), -1).otherwise(hashed).cast("int")


class AccessDenied(PermissionError):
    """The role or the view is not covered by the policy."""


@dataclasses.dataclass(frozen=True)
class Policy:
    """Protected views with their territory column, and roles that may read them."""

    columns: Mapping[str, str]
    roles: frozenset[str]

    def column_for(self, view: str, role: str) -> str:
        if role not in self.roles:
            raise AccessDenied(f"role {role!r} may not read {view!r}")
        if view not in self.columns:
            raise AccessDenied(f"view {view!r} has no access rule")
        return self.columns[view]


# Protected views with their territory column.
PROTECTED = {
    "secondary_sales_view": "wss_territory_code",
    "secondary_sales_mat_view": "wss_territory_code",
    "rls_master_view": "wss_territory_code",
}


def policy_of(settings: Mapping) -> Policy:
    """Policy of a tenant: the roles of its settings, all of them filtered, over the protected views.

    Without roles nobody may read anything.
    """
    return Policy({**PROTECTED, **settings.get("protected_views", {})}, frozenset(settings.get("roles", ())))


def mail_territories(hierarchy: DataFrame, levels: tuple[str, ...] = MAIL_LEVELS) -> DataFrame:
    """Distinct (email, territory) pairs over all hierarchy levels, in one scan."""
    pairs = unpivot(
        hierarchy.filter(F.col("txn_type").like(HIERARCHY_KIND)), ["wss_territory_code"], list(levels), "level", "email"
    )
    return (
        pairs.filter(not_blank("email"))
        .select(mail_key("email").alias("email"), "wss_territory_code")
        .distinct()
    )


def access_map(hierarchy: DataFrame) -> DataFrame:
    """Per e-mail the sorted territories. Pairs are made distinct before grouping."""
    return (
        mail_territories(hierarchy)
        .groupBy("email")
        .agg(F.array_sort(F.collect_list("wss_territory_code")).alias("wss_territory_code"))
        .withColumn("territory_count", F.size("wss_territory_code").cast("bigint"))
    )


def dealer_map(hierarchy: DataFrame, dealers: DataFrame) -> DataFrame:
    """Distinct (email, dealer_code) pairs: the dealers in a user's territories.

    Rows, not arrays: the head of a company sees all its dealers.
    """
    side = dealers.select(F.col("tsi_territory_code").alias("_territory"), "dealer_code").distinct()
    pairs = mail_territories(hierarchy)
    return pairs.join(side, pairs["wss_territory_code"] == F.col("_territory")).select("email", "dealer_code").distinct()


def hierarchy_paths(hierarchy: DataFrame) -> DataFrame:
    """Reporting line of every hierarchy row as a dot-separated path.

    Empty addresses are left out, then elements equal to the one before;
    lines with fewer than two people are dropped.
    """
    people = F.filter(F.array(*MAIL_LEVELS), lambda m: m.isNotNull() & (m != ""))
    steps = F.transform("_people", lambda m: mail_path_element(m))
    line = F.filter(
        "_steps",
        lambda s, i: (s != "") & ((i == 0) | (F.get("_steps", i - 1) != s)),
    )
    return (
        hierarchy.filter(F.col("txn_type").like(HIERARCHY_KIND) & F.col("sh_2_email").isNotNull())
        .withColumn("_people", people)
        .withColumn("_steps", steps)
        .withColumn("_line", line)
        .filter(F.size("_line") >= 2)
        .select(
            F.col("cluster_code").alias("cluster"),
            F.col("division_code").alias("division"),
            F.element_at("_people", 1).alias("email_id"),
            F.array_join("_line", ".").alias("hierarchy_path"),
            "sales_group",
            *[F.col(m).alias(m.removesuffix("_email")) for m in MAIL_LEVELS],
            "wss_territory_code",
        )
    )


def path_territories(master: DataFrame, email: str) -> DataFrame:
    """Territories below a person: those whose path has the person as an element."""
    element = mail_path_element(F.lit(email))
    on_path = F.array_contains(F.split("hierarchy_path", r"\."), element)
    return master.filter(on_path & F.col("wss_territory_code").isNotNull()).select("wss_territory_code").distinct()


def territories_of(access: DataFrame, email: str) -> DataFrame:
    """One row per territory of a user; none for an unknown user."""
    mine = access.filter(mail_key("email") == mail_key(F.lit(email)))
    return mine.select(F.explode("wss_territory_code").alias("territory")).distinct()


def secure(
    view: str, df: DataFrame, access: DataFrame, email: str, role: str, policy: Policy
) -> DataFrame:
    """Rows of a protected view that the user may see."""
    return secured_views({view: df}, access, email, role, policy)[view]


def secured_views(
    views: Mapping[str, DataFrame], access: DataFrame, email: str, role: str, policy: Policy
) -> dict[str, DataFrame]:
    """All given views, each limited to the user's rows.

    The user's territories are measured first. As a rule they are few and go to
    the view's rows; otherwise the view would be shuffled by territory.
    """
    columns = {name: policy.column_for(name, role) for name in views}
    mine = broadcast_if_small(territories_of(access, email))
    parts = mine.select("territory", part_of("territory").alias("_part"))
    return {
        name: _in_parts(df, columns[name], parts).drop(PART) if PART in df.columns else members(df, columns[name], mine, "territory")
        for name, df in views.items()
    }


def _in_parts(df: DataFrame, column: str, parts: DataFrame) -> DataFrame:
    """``members`` of a stored view: the parts of the user's territories are found at run time, the others are not read."""
    side = parts.withColumnRenamed("territory", "_allowed")
    return df.join(side, (df[column] == F.col("_allowed")) & (df[PART] == F.col("_part")), "left_semi")


#: Parsed operators a query may consist of. Anything else (commands, table functions, scripts) is refused.
_ALLOWED = frozenset(
    """
    Project Filter Aggregate Join Union Distinct Except Intersect Sort GlobalLimit LocalLimit Offset Sample
    SubqueryAlias UnresolvedSubqueryColumnAliases UnresolvedWith UnresolvedRelation UnresolvedHaving
    OneRowRelation UnresolvedInlineTable LocalRelation WithWindowDefinition Window Pivot Unpivot LateralJoin Generate
    """.split()
)
#: Parsed expressions a query may consist of. Names that are themselves expressions (identifier clauses) are not among them.
_EXPRESSIONS = frozenset(
    """
    Literal AttributeReference Alias UnresolvedAlias UnresolvedAttribute UnresolvedStar UnresolvedStarExceptOrReplace
    UnresolvedExtractValue UnresolvedOrdinal UnresolvedCollation UnresolvedFunction UnresolvedGenerator
    LambdaFunction UnresolvedNamedLambdaVariable
    Add Subtract Multiply Divide IntegralDivide Remainder UnaryMinus UnaryPositive Concat
    BitwiseAnd BitwiseOr BitwiseXor BitwiseNot ShiftLeft ShiftRight ShiftRightUnsigned
    And Or Not EqualTo EqualNullSafe GreaterThan GreaterThanOrEqual LessThan LessThanOrEqual Between UnresolvedBetween
    In InSubquery IsNull IsNotNull Like LikeAll LikeAny NotLikeAll NotLikeAny ILike RLike
    CaseWhen If Coalesce Cast Collate Extract StringLocate StringTrim StringTrimLeft StringTrimRight Substring Overlay
    TimestampAdd TimestampDiff CreateNamedStruct CreateStruct SemiStructuredExtract
    ScalarSubquery ListQuery Exists LateralSubquery
    SortOrder AggregateExpression AnyValue First Last GroupingSets Rollup Cube
    WindowExpression UnresolvedWindowExpression WindowSpecDefinition WindowSpecReference SpecifiedWindowFrame
    UnspecifiedFrame$ CurrentRow$ UnboundedPreceding$ UnboundedFollowing$
    """.split()
)
#: Built-in functions that reach outside the query, and the expressions they become.
_OUTSIDE = frozenset({"reflect", "java_method", "try_reflect"})
_OUTSIDE_EXPRESSIONS = frozenset({"CallMethodViaReflection", "TryReflect"})
#: Leaves of an analysed query besides the given views.
_NO_SOURCES = frozenset({"OneRowRelation", "LocalRelation", "EmptyRelation", "CTERelationRef"})


class _Reader:
    """Collects what a user's text reads, from Spark's own parse of it; refuses what may read anything else."""

    def __init__(self, spark: SparkSession, text: str):
        self.found: set[str] = set()
        self.functions = {r[0].lower() for r in spark.sql("SHOW SYSTEM FUNCTIONS").collect()} - _OUTSIDE
        java = spark._jvm.java.lang.Class
        base = "org.apache.spark.sql.catalyst."
        loader = spark._jvm.java.lang.Thread.currentThread().getContextClassLoader()
        self.subquery = java.forName(base + "expressions.PlanExpression", True, loader)
        try:
            parsed = spark._jsparkSession.sessionState().sqlParser().parsePlan(text)
        except ParseException as err:
            raise AccessDenied("the text cannot be read as a query") from err
        self.plan(parsed, frozenset())

    @staticmethod
    def _items(seq) -> list:
        return [seq.apply(i) for i in range(seq.size())]

    def known(self, function: str) -> None:
        if function.lower() not in self.functions:
            raise AccessDenied(f"function {function} is not allowed in a query")

    def plan(self, node, defined: frozenset[str]) -> None:
        """``defined``: names of the query's own CTEs in scope; they hide tables of the same name."""
        kind = node.getClass().getSimpleName()
        if kind not in _ALLOWED:
            raise AccessDenied(f"{kind} is not allowed in a query")
        if kind == "UnresolvedRelation":
            parts = self._items(node.multipartIdentifier())
            if len(parts) > 1 or parts[0].lower() not in defined:
                self.found.add(".".join(parts))
            return
        if kind == "UnresolvedWith":
            for pair in self._items(node.cteRelations()):
                self.plan(pair._2(), defined)
                defined |= {pair._1().lower()}
            self.plan(node.child(), defined)
            return
        if kind == "WithWindowDefinition":
            for definition in self._items(node.windowDefinitions().values().toSeq()):
                self.expression(definition, defined)
        for expression in self._items(node.expressions()):
            self.expression(expression, defined)
        for child in self._items(node.children()):
            self.plan(child, defined)

    def expression(self, node, defined: frozenset[str]) -> None:
        kind = node.getClass().getSimpleName()
        if kind not in _EXPRESSIONS:
            raise AccessDenied(f"{kind} is not allowed in a query")
        if self.subquery.isInstance(node):
            self.plan(node.plan(), defined)
        elif kind == "UnresolvedFunction":
            self.known(".".join(self._items(node.nameParts())))
        elif kind == "UnresolvedGenerator":
            self.known(node.name().unquotedString())
        for child in self._items(node.children()):
            self.expression(child, defined)


def _check_analysed(df: DataFrame, names: Collection[str]) -> None:
    """Refuse an analysed query that reads anything but the named views, or calls what is no expression of Spark's own.

    The second look at a text that passed the first: names are resolved here,
    whatever way they were written.
    """
    items = _Reader._items

    def plan(node) -> None:
        kind = node.getClass().getSimpleName()
        if kind == "View":
            if node.desc().identifier().table() not in names:
                raise AccessDenied(f"only the given views may be read, not {node.desc().identifier().table()}")
            return
        inner = items(node.children())
        if not inner and kind not in _NO_SOURCES:
            raise AccessDenied(f"{kind} is not allowed in a query")
        for child in [*inner, *items(node.innerChildren())]:
            plan(child)
        for e in items(node.expressions()):
            expression(e)

    def expression(node) -> None:
        kind = node.getClass()
        if not kind.getName().startswith("org.apache.spark.sql.catalyst.") or kind.getSimpleName() in _OUTSIDE_EXPRESSIONS or "UDF" in kind.getSimpleName():
            raise AccessDenied(f"{kind.getSimpleName()} is not allowed in a query")
        if holds_plan(node):
            plan(node.plan())
        for child in items(node.children()):
            expression(child)

    java = df.sparkSession._jvm.java.lang.Class
    loader = df.sparkSession._jvm.java.lang.Thread.currentThread().getContextClassLoader()
    holds_plan = java.forName("org.apache.spark.sql.catalyst.expressions.PlanExpression", True, loader).isInstance
    plan(df._jdf.queryExecution().analyzed())


def query_as(
    spark: SparkSession,
    text: str,
    views: Mapping[str, DataFrame],
    access: DataFrame,
    email: str,
    role: str,
    policy: Policy,
) -> DataFrame:
    """Run a user's SQL over secured views, named ``{view}`` in the text.

    The text must be one query that reads nothing but these placeholders and
    the names it defines itself: commands, other tables and views, files, table
    functions, functions that are not built in and names given by expressions
    are refused before anything is run. What Spark makes of the text is checked
    once more. The secured views have random names while the text is analysed.
    """
    secured = secured_views(views, access, email, role, policy)
    tag = uuid.uuid4().hex
    names = {view: f"_secured_{i}_{tag}" for i, view in enumerate(secured)}
    plain = re.sub(r"\{(\w+)\}", lambda m: names.get(m[1], m[0]), text)
    strange = _Reader(spark, plain).found - set(names.values())
    if strange:
        raise AccessDenied(f"only the given views may be read, not {sorted(strange)}")
    try:
        for view, name in names.items():
            secured[view].createOrReplaceTempView(name)
        result = spark.sql(plain)
        _check_analysed(result, set(names.values()))
        return result
    finally:
        for name in names.values():
            spark.catalog.dropTempView(name)
