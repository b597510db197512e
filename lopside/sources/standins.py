"""Stand-in tables built over the driver's parquet files.

The four datasets that the analytics were written for are not shipped. These views
give tables of the same shape from ``events``, ``orders`` + ``customer``,
``documents`` and ``labels``. Each exists twice: as DataFrame code and as SQL for
the checks.
"""

from __future__ import annotations

import re
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lopside.functions.transactions import engineer_transactions
from lopside.operators.profile import dedup_first
from lopside.operators.splits import temporal_split

TIME_CUT = "2024-01-22 00:00:00"
CHURN_CATEGORICAL = ["Geography", "Gender"]
CHURN_NUMERIC = ["CreditScore", "Age", "Tenure", "Balance", "NumOfProducts", "HasCrCard",
                 "IsActiveMember", "EstimatedSalary"]


class Tables:
    """Lazy access to the parquet tables of one folder and the views over them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def read(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def txn(self) -> DataFrame:
        return self.read("events").selectExpr(
            "event_id as row_id", "ts as trans_date_trans_time", "user_id as cc_num",
            "concat('cat_', lpad(cast(cast(get_json_object(props,'$.k') as int) % 14 as string), 2, '0'))"
            " as category",
            "value as amt", "case when user_id % 2 = 0 then 'F' else 'M' end as gender",
            "date_add(date'1940-01-01', cast(user_id*4001 % 21900 as int)) as dob",
            "25 + (user_id*37 % 2400)/100.0D as lat", "-120 + (user_id*53 % 5000)/100.0D as long",
            "25 + (user_id*37 % 2400)/100.0D + ((event_id*31 % 201) - 100)/100.0D as merch_lat",
            "-120 + (user_id*53 % 5000)/100.0D + ((event_id*17 % 201) - 100)/100.0D as merch_long",
            "500 + (user_id*7919 % 100000) as city_pop",
            "case when event_type='error' and event_id % 50 = 0 then 1 else 0 end as is_fraud",
            "0.7D * (floor((event_id*7919 % 10007)/10007.0D*1000)/1000)"
            " + 0.3D * (case when event_type='error' and event_id % 50 = 0 then 1 else 0 end) as score")

    @cached_property
    def txn_parts(self) -> tuple[DataFrame, DataFrame]:
        return temporal_split(self.txn, "trans_date_trans_time", TIME_CUT)

    @cached_property
    def features(self) -> DataFrame:
        return engineer_transactions(
            self.txn, keep=("row_id", "cc_num", "trans_date_trans_time", "is_fraud", "score"))

    @cached_property
    def feature_parts(self) -> tuple[DataFrame, DataFrame]:
        return temporal_split(self.features, "trans_date_trans_time", TIME_CUT)

    @cached_property
    def churn(self) -> DataFrame:
        orders = self.read("orders").groupBy("o_custkey").agg(
            F.count("*").alias("n"), F.max("o_orderdate").alias("last"),
            F.sum(F.round(F.col("o_totalprice") * 100).cast("bigint")).alias("cents"),
            F.datediff(F.lit("2001-08-01").cast("date"), F.min("o_orderdate")).alias("days"),
            F.sum(F.when(F.col("o_orderpriority") == "1-URGENT", 1).otherwise(0)).alias("urgent"))
        # nation and region have a fixed number of rows.
        places = self.read("nation").join(
            F.broadcast(self.read("region")), F.col("n_regionkey") == F.col("r_regionkey"))
        return (self.read("customer")
                .join(F.broadcast(places), F.col("c_nationkey") == F.col("n_nationkey"))
                .join(orders, F.col("c_custkey") == F.col("o_custkey"))
                .selectExpr(
                    "c_custkey as CustomerId", "c_name as Surname",
                    "300 + (c_custkey*7919 % 551) as CreditScore", "r_name as Geography",
                    "case when c_custkey % 2 = 0 then 'Female' else 'Male' end as Gender",
                    "18 + (c_custkey*31 % 75) as Age", "cast(floor(days/365.25D) as int) as Tenure",
                    "c_acctbal as Balance",
                    "cast(least(4, 1 + floor(n/5.0D)) as int) as NumOfProducts",
                    "case when c_custkey % 3 <> 0 then 1 else 0 end as HasCrCard",
                    "case when urgent > 1 then 1 else 0 end as IsActiveMember",
                    "floor(cents/n)/100.0D as EstimatedSalary",
                    "case when last < timestamp_ntz'2000-07-01 00:00:00' then 1 else 0 end as Exited"))

    @cached_property
    def genre(self) -> DataFrame:
        """Documents with their language as the class.

        ``pred`` stands in for a model: very short or very long texts are guessed.
        """
        return self.read("documents").selectExpr(
            "doc_id as id",
            "concat('Doc ', cast(doc_id as string), ' (', cast(1950 + doc_id % 70 as string), ')') as title",
            "lang as genre", "source", "text as description",
            "case when length(text) < 300 then 'en' when length(text) > 6000 then 'fr' "
            "when length(text) between 700 and 800 then 'de' else lang end as pred")

    @cached_property
    def sms(self) -> DataFrame:
        return (self.read("labels").join(self.read("documents"), "doc_id")
                .selectExpr("doc_id as row_id",
                            "case when toxic = 1 then 'spam' else 'ham' end as label",
                            "text as message"))

    @cached_property
    def sms_unique(self) -> DataFrame:
        return dedup_first(self.sms, ["message"], "row_id")


SQL_VIEWS = {
    "txn": """
 select event_id as row_id, ts as trans_date_trans_time, user_id as cc_num,
  concat('cat_', lpad(cast(cast(json_extract_string(props,'$.k') as int) % 14 as varchar), 2, '0')) as category,
  value as amt, case when user_id % 2 = 0 then 'F' else 'M' end as gender,
  cast(date '1940-01-01' + cast(user_id*4001 % 21900 as int) as date) as dob,
  25 + (user_id*37 % 2400)/100.0e0 as lat, -120 + (user_id*53 % 5000)/100.0e0 as long,
  25 + (user_id*37 % 2400)/100.0e0 + ((event_id*31 % 201) - 100)/100.0e0 as merch_lat,
  -120 + (user_id*53 % 5000)/100.0e0 + ((event_id*17 % 201) - 100)/100.0e0 as merch_long,
  500 + (user_id*7919 % 100000) as city_pop,
  case when event_type='error' and event_id % 50 = 0 then 1 else 0 end as is_fraud,
  0.7e0 * (floor((event_id*7919 % 10007)/10007.0e0*1000)/1000)
   + 0.3e0 * (case when event_type='error' and event_id % 50 = 0 then 1 else 0 end) as score
 from events""",
    "feat": """
 select row_id, cc_num, trans_date_trans_time, is_fraud, score, amt, category,
  cast(extract(hour from trans_date_trans_time) as int) as hour,
  case when extract(hour from trans_date_trans_time) in (22, 23, 0, 1, 2, 3) then 1 else 0 end as is_night,
  cast(isodow(trans_date_trans_time) - 1 as int) as dayofweek,
  date_diff('day', dob, cast(trans_date_trans_time as date)) / 365.25e0 as age, gender, city_pop,
  2 * 6371.0e0 * asin(sqrt(
    pow(sin(radians(merch_lat - lat) / 2), 2)
    + cos(radians(lat)) * cos(radians(merch_lat)) * pow(sin(radians(merch_long - long) / 2), 2)))
   as distance_km
 from txn""",
    "txn_train": f" select * from txn where trans_date_trans_time < timestamp '{TIME_CUT}'",
    "txn_test": f" select * from txn where trans_date_trans_time >= timestamp '{TIME_CUT}'",
    "feat_train": f" select * from feat where trans_date_trans_time < timestamp '{TIME_CUT}'",
    "feat_test": f" select * from feat where trans_date_trans_time >= timestamp '{TIME_CUT}'",
    "churn": """
 select c.c_custkey as CustomerId, c.c_name as Surname, 300 + (c.c_custkey*7919 % 551) as CreditScore,
  r.r_name as Geography, case when c.c_custkey % 2 = 0 then 'Female' else 'Male' end as Gender,
  18 + (c.c_custkey*31 % 75) as Age, cast(floor(o.days/365.25e0) as int) as Tenure, c.c_acctbal as Balance,
  cast(least(4, 1 + floor(o.n/5.0e0)) as int) as NumOfProducts,
  case when c.c_custkey % 3 <> 0 then 1 else 0 end as HasCrCard,
  case when o.urgent > 1 then 1 else 0 end as IsActiveMember,
  floor(o.cents/o.n)/100.0e0 as EstimatedSalary,
  case when o.last < timestamp '2000-07-01 00:00:00' then 1 else 0 end as Exited
 from customer c join nation n on c.c_nationkey = n.n_nationkey join region r on n.n_regionkey = r.r_regionkey
 join (select o_custkey, count(*) n, max(o_orderdate) as last,
        sum(cast(round(o_totalprice*100) as bigint)) cents,
        date_diff('day', cast(min(o_orderdate) as date), date '2001-08-01') as days,
        sum(case when o_orderpriority='1-URGENT' then 1 else 0 end) urgent
      from orders group by o_custkey) o on o.o_custkey = c.c_custkey""",
    "genre": """
 select doc_id as id, concat('Doc ', cast(doc_id as varchar), ' (', cast(1950 + doc_id % 70 as varchar), ')') as title,
  lang as genre, source, text as description,
  case when length(text) < 300 then 'en' when length(text) > 6000 then 'fr'
       when length(text) between 700 and 800 then 'de' else lang end as pred
 from documents""",
    "sms": """
 select l.doc_id as row_id, case when l.toxic = 1 then 'spam' else 'ham' end as label, d.text as message
 from labels l join documents d on l.doc_id = d.doc_id""",
    "sms_unique": """
 select row_id, label, message from (
  select *, row_number() over (partition by message order by row_id) as rn from sms) where rn = 1""",
}
_NEEDS = {"feat": ["txn"], "txn_train": ["txn"], "txn_test": ["txn"], "feat_train": ["txn", "feat"],
          "feat_test": ["txn", "feat"], "sms_unique": ["sms"]}


def with_views(sql: str) -> str:
    """Prefix a query with the stand-in views it names."""
    used = [v for v in SQL_VIEWS if re.search(rf"\b{v}\b", sql)]
    needed = {n for v in used for n in [*_NEEDS.get(v, []), v]}
    if not needed:
        return sql.strip()
    views = ",\n".join(f"{v} as ({SQL_VIEWS[v]})" for v in SQL_VIEWS if v in needed)
    return f"with {views}\nselect * from ({sql.strip()}) as answer"
