"""Relevance cascade of the modular extraction.

An ordered rule list where the first matching rule decides; it becomes one
``CASE`` that returns the rule number, so every outcome can be counted in the
same pass that filters.

Rules: 1 no address -> drop; (2: a non-integer port turns both ports into 0);
3 any port 53 -> keep; 4 any web port -> keep; 5 any noise port -> drop;
6 any important port -> keep; 7 not both internal -> keep; 8 any application
field -> keep; 9 otherwise -> drop.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import constants as K
from ..functions import fields as X
from ..functions.addresses import is_internal, octets
from ..session import bind

KEEP_RULES = (3, 4, 6, 7, 8)


def _either(a: Column, b: Column, values: list[int]) -> Column:
    return a.isin(*values) | b.isin(*values)


def with_relevance(df: DataFrame) -> DataFrame:
    """Adds ``relevance_rule`` (1-9) and ``relevant`` (kept by the cascade).

    Values that several rules read are bound once per row.
    """
    c = F.col
    zero = F.lit(0).cast("bigint")

    def port(name: str) -> Column:
        return F.when(X.is_missing(c(name)), zero).otherwise(X.integer_text_value(c(name)))

    staged = bind(df, _rs=port("src_port"), _rd=port("dst_port"), _os=octets(c("src_ip")), _od=octets(c("dst_ip")))
    both = c("_rs").isNotNull() & c("_rd").isNotNull()
    staged = bind(staged, _s=F.when(both, c("_rs")).otherwise(zero), _d=F.when(both, c("_rd")).otherwise(zero),
                  _internal=is_internal(c("_os")) & is_internal(c("_od")))
    app_data = (~X.is_missing(c("http_host")) | ~X.is_missing(c("http_path"))
                | ~X.is_missing(c("user_agent")) | ~X.is_missing(c("dns_query")))
    s, d = c("_s"), c("_d")
    rule = (
        F.when(X.is_missing(c("src_ip")) | X.is_missing(c("dst_ip")), 1)
        .when((s == K.DNS_PORT) | (d == K.DNS_PORT), 3)
        .when(_either(s, d, K.WEB_PORTS), 4)
        .when(_either(s, d, K.NOISE_PORTS), 5)
        .when(_either(s, d, K.IMPORTANT_PORTS), 6)
        .when(~c("_internal"), 7)
        .when(app_data, 8)
        .otherwise(9)
    )
    return (bind(staged, relevance_rule=rule)
            .withColumn("relevant", F.col("relevance_rule").isin(*KEEP_RULES))
            .drop("_rs", "_rd", "_os", "_od", "_s", "_d", "_internal"))
