"""Attaching industry, state and legislator attributes to transactions."""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from obligo.functions.clean import whole_number
from obligo.operators.joins import BROADCAST_BYTES, Sized, join_dimension, measure
from obligo.schemas import CONTRACT_DETAIL, GRANT_DETAIL

# The two ways a chamber is attached to a transaction.
SEAT_KEYS = {"district": ["state", "district", "year"], "state": ["state", "year"]}


@dataclass(frozen=True)
class Dimensions:
    """Measured dimension tables.

    ``legislators`` keeps the rows as delivered; ``holders`` has identical rows only once.
    """

    labels: Sized
    states: Sized
    legislators: Sized
    holders: Sized

    @classmethod
    def measured(cls, labels: DataFrame, states: DataFrame, legislators: DataFrame,
                 limit: int = BROADCAST_BYTES) -> Dimensions:
        """``limit`` is the size in bytes up to which they are broadcast."""
        return cls(**measure({
            "labels": labels,
            "states": states,
            "legislators": legislators,
            "holders": legislators.dropDuplicates(),
        }, limit))

    def release(self) -> None:
        for part in (self.labels, self.states, self.legislators, self.holders):
            part.df.unpersist()


def with_industry(contracts: DataFrame, labels: Sized) -> DataFrame:
    """Every contract, with the name of its industry where there is one."""
    return join_dimension(contracts, labels, ["code"])


def with_state(contracts: DataFrame, states: Sized) -> DataFrame:
    """Every contract, with the demographics of its state where they are known."""
    return join_dimension(contracts, states, ["state"])


def labels_with_contracts(contracts: DataFrame, labels: Sized) -> DataFrame:
    """Every industry label with its contracts; an unused label has one row without a contract.

    This is labels LEFT JOIN contracts. Joined that way round, Spark would have to shuffle all
    contracts by code. Instead the contracts pick up their label in place, and the labels
    nobody uses come from a second pass that reads only the code column.
    """
    matched = join_dimension(contracts, labels, ["code"], "inner")
    used = join_dimension(contracts.select("code"), replace(labels, df=labels.df.select("code")),
                          ["code"], "inner").distinct()
    unused = labels.df.join(used, "code", "left_anti")
    absent = [F.lit(None).cast(f.dataType).alias(f.name)
              for f in contracts.schema.fields if f.name != "code"]
    return matched.unionByName(unused.select("code", "description", *absent))


def with_legislator(transactions: DataFrame, legislators: Sized,
                    chamber_key: str = "district") -> DataFrame:
    """Every transaction, once per legislator of its seat and year.

    ``chamber_key="state"`` attaches by state and year only, which is how senators, who have no
    district, can be attached at all.
    """
    keys = SEAT_KEYS[chamber_key]
    rows = legislators
    if chamber_key == "state":
        rows = replace(legislators, df=legislators.df.drop("district"))
    return join_dimension(transactions, rows, keys)


def with_senator(transactions: DataFrame, legislators: Sized) -> DataFrame:
    """Every transaction, once per senator of its state and year; each gets the full amount."""
    senators = replace(legislators,
                       df=legislators.df.filter(F.col("typeofrep") == "sen"))
    return with_legislator(transactions, senators, "state")


def enriched(contracts: DataFrame, dims: Dimensions, chamber: str,
             chamber_key: str = "district", distinct: str = "holders") -> DataFrame:
    """Contracts of one chamber with all attributes, without the repeats the join makes.

    ``distinct="holders"`` removes duplicates among the legislator-years before the join, which
    needs no shuffle of the contracts. Where every transaction has an id of its own this is the
    DISTINCT of the result. ``distinct="rows"`` is the literal DISTINCT of whole rows, which also
    makes one of transactions that are delivered more than once.
    """
    if distinct not in ("holders", "rows"):
        raise ValueError("distinct must be 'holders' or 'rows'")
    people = dims.holders if distinct == "holders" else dims.legislators
    people = replace(people, df=people.df.filter(F.col("typeofrep") == chamber))
    attached = with_legislator(contracts, people, chamber_key).filter(
        F.col("typeofrep") == chamber
    )
    rows = with_state(with_industry(attached, dims.labels), dims.states)
    return rows.dropDuplicates() if distinct == "rows" else rows


def contract_detail(contracts: DataFrame, labels: Sized, legislators: Sized,
                    dedup: bool = False) -> DataFrame:
    """The published contract table: labelled contracts, once per legislator.

    ``contracts`` keep their full code here. By default rows repeat where the legislator-years
    do; ``dedup=True`` removes the repeats.
    """
    rows = with_legislator(
        labels_with_contracts(contracts, labels), _once(legislators) if dedup else legislators
    )
    return _published(rows, CONTRACT_DETAIL)


def grant_detail(grants: DataFrame, legislators: Sized, dedup: bool = False) -> DataFrame:
    """The published grant table. The district stays as delivered; only its number is matched."""
    keyed = grants.withColumnRenamed("district", "district_label").withColumn(
        "district", whole_number(F.col("district_label"))
    )
    rows = (
        with_legislator(keyed, _once(legislators) if dedup else legislators)
        .drop("district")
        .withColumnRenamed("district_label", "district")
    )
    return _published(rows, GRANT_DETAIL)


def _once(legislators: Sized) -> Sized:
    """Identical legislator-years once, so that each transaction meets each of them once."""
    return replace(legislators, df=legislators.df.dropDuplicates())


def _published(rows: DataFrame, columns: list[str]) -> DataFrame:
    texts = {"year": F.col("year").cast("string"), "district": F.col("district").cast("string")}
    return rows.withColumns(texts).select(*columns)
