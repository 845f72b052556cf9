"""Clinical views over the driver tables (the mapping of FIXTURES.md)."""

from __future__ import annotations

import datetime as dt

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lowtide import model as M
from lowtide.functions import codes, dates
from lowtide.sources import vocabulary as V

LONG = T.LongType()
TABLES = {
    "customer": M.schema(c_custkey=LONG),
    "orders": M.schema(o_orderkey=LONG, o_custkey=LONG, o_orderstatus=M.STRING, o_totalprice=M.DOUBLE,
                       o_orderdate=M.TS, o_orderpriority=M.STRING),
    "lineitem": M.schema(l_orderkey=LONG, l_partkey=LONG, l_suppkey=LONG, l_linenumber=M.INT, l_quantity=M.DOUBLE,
                         l_returnflag=M.STRING, l_shipdate=M.TS),
    "part": M.schema(p_partkey=LONG, p_name=M.STRING, p_brand=M.STRING, p_type=M.STRING, p_size=M.INT,
                     p_retailprice=M.DOUBLE),
    "documents": M.schema(doc_id=LONG, lang=M.STRING, source=M.STRING, n_chars=LONG),
    "labels": M.schema(doc_id=LONG, quality=M.INT, toxic=M.INT),
}

STUDY = M.Study(service_from=dt.date(1996, 1, 1), claim_from=dt.date(1996, 1, 1),
                start=dt.date(1998, 1, 1), end=dt.date(1999, 1, 1), admissions_to=dt.date(1999, 3, 1))
AS_OF = dt.date(1999, 1, 1)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table under its declared schema (no footer inference)."""
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def local(spark: SparkSession, schema: T.StructType, rows: list[tuple]) -> DataFrame:
    """Literal rows as a local relation, so that Catalyst knows their size."""
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    kinds = {"string": pa.string(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(),
             "date": pa.date32()}
    arrays = [pa.array(list(values), kinds[field.dataType.simpleString()]) for field, values in zip(schema, columns)]
    return spark.createDataFrame(pa.table(arrays, names=schema.names), schema=schema)


def pick(values: list[str], index: Column) -> Column:
    """The value at a zero-based position of a fixed list."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (index + 1).cast("int"))


def mrn(key: Column) -> Column:
    return F.lpad(key.cast("string"), 9, "0")


def icd10_of(index: Column) -> Column:
    return pick([ten for ten, _ in V.DIAGNOSES], index)


def icd9_of(index: Column) -> Column:
    return pick([nine for _, nine in V.DIAGNOSES], index)


def _diagnosis_index() -> Column:
    return (F.col("o_orderkey") * 7 + F.col("o_custkey")) % len(V.DIAGNOSES)


def _aged(df: DataFrame, patients: DataFrame, when: str) -> DataFrame:
    return df.join(patients, "MRN").withColumn("AGEATCLAIM", F.datediff(F.col(when), F.col("DOB")))


def patient(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        mrn(key).alias("MRN"),
        F.date_add(F.lit("1920-01-01").cast("date"), ((key * 7919) % 25000).cast("int")).alias("DOB"),
        F.when(key % 2 == 0, "F").otherwise("M").alias("GENDER"),
    )


def raw_claim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Diagnosis rows before the patient join: ICD-10 and the paired ICD-9."""
    return table(spark, sf_dir, "orders").select(
        mrn(F.col("o_custkey")).alias("MRN"),
        F.col("o_orderkey").cast("string").alias("ENC_ID"),
        F.col("o_orderdate").alias("EVT_DATE"),
        icd10_of(_diagnosis_index()).alias("CODE"),
        icd9_of(_diagnosis_index()).alias("ICD9_CODE"),
    )


def claim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _aged(raw_claim(spark, sf_dir), patient(spark, sf_dir), "EVT_DATE")


def procedure_claim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Claims plus a few feeding-tube procedure rows."""
    extra = (
        table(spark, sf_dir, "orders")
        .filter((F.col("o_orderpriority") == "1-URGENT") & (F.col("o_orderkey") % 29 == 0))
        .select(
            mrn(F.col("o_custkey")).alias("MRN"),
            F.col("o_orderkey").cast("string").alias("ENC_ID"),
            F.col("o_orderdate").alias("EVT_DATE"),
            F.lit(V.FEEDING_TUBE_PCS).alias("CODE"),
            F.lit("43.11").alias("ICD9_CODE"),
        )
    )
    return _aged(raw_claim(spark, sf_dir).unionByName(extra), patient(spark, sf_dir), "EVT_DATE")


def older_claim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ICD-9 coded diagnosis rows of the earlier period."""
    return (
        table(spark, sf_dir, "orders")
        .select(
            mrn(F.col("o_custkey")).alias("MRN"),
            F.col("o_orderkey").cast("string").alias("ENC_ID"),
            F.col("o_orderdate").alias("EVT_DATE"),
            icd9_of(_diagnosis_index()).alias("CODE"),
        )
    )


def raw_service(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_shipdate")
    return lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        mrn(F.col("o_custkey")).alias("MRN"),
        F.col("l_orderkey").cast("string").alias("ENC_ID"),
        pick(V.PROCEDURES, F.col("l_partkey") % len(V.PROCEDURES)).alias("CODE"),
        F.col("l_shipdate").alias("EVT_DATE"),
    )


def service(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _aged(raw_service(spark, sf_dir), patient(spark, sf_dir), "EVT_DATE")


def raw_rx(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    lines = (
        table(spark, sf_dir, "lineitem")
        .filter(F.col("l_returnflag") == "R")
        .select("l_orderkey", "l_partkey", "l_shipdate")
    )
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .select(mrn(F.col("o_custkey")).alias("MRN"), F.col("p_name").alias("MED_NAME"),
                F.col("l_shipdate").alias("ENTRY_DATE"))
    )


def rx(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _aged(raw_rx(spark, sf_dir), patient(spark, sf_dir), "ENTRY_DATE")


def encounter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hospital stays with class and service, before the BLD8 selection."""
    order = F.col("o_orderkey")
    day = F.col("o_orderdate")
    stay = F.make_dt_interval((order % 6 + 1).cast("int"))
    return (
        table(spark, sf_dir, "orders")
        .filter(F.col("o_orderstatus") == "F")
        .select(
            mrn(F.col("o_custkey")).alias("MRN"),
            order.cast("string").alias("ENC_ID"),
            day.alias("ADM_DT"),
            (day + stay).alias("DIS_DT"),
            F.element_at(F.create_map(*[F.lit(x) for pair in (("1", "I"), ("2", "O"), ("3", "E"), ("4", "I"), ("5", "P"))
                                        for x in pair]), F.substring("o_orderpriority", 1, 1)).alias("PT_CLASS"),
            F.when(order % 2 == 0, "GMD").otherwise("OUT").alias("SRV_CODE"),
        )
    )


def visits(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The two encounter tables of SRC3: (all stays, clinic contacts)."""
    orders = table(spark, sf_dir, "orders")
    stays = orders.select(mrn(F.col("o_custkey")).alias("MRN"), F.col("o_orderdate").alias("ADM_DT"))
    contacts = orders.filter(F.col("o_orderstatus") == "O").select(
        mrn(F.col("o_custkey")).alias("MRN"), F.col("o_orderdate").alias("CONTACT_DT"))
    return stays, contacts


# --- reference tables ------------------------------------------------------

def written_rules(spark: SparkSession, generation: int) -> DataFrame:
    """Rules as written: dotted codes with stem marks."""
    return local(spark, M.schema(role=M.STRING, metric=M.STRING, cls=M.STRING, code=M.STRING), V.RULES[generation])


def demographics(spark: SparkSession) -> DataFrame:
    return local(spark, M.schema(key=M.STRING, agemin=M.INT, agemax=M.INT, gendercrit=M.STRING), V.DEMOGRAPHICS)


def surgery(spark: SparkSession) -> DataFrame:
    return local(spark, M.schema(metric=M.STRING, code=M.STRING), V.SURGERY)


def crosswalk(spark: SparkSession) -> DataFrame:
    names = ["ICD9_CODE", "ICD10_CODE", "ICD9_subcode", "ICD10_subcode", "ICD9_TYPE", "ICD10_TYPE", "ICD9_DESC",
             "ICD10_DESC", "RELATION_TYPE", "MAPPING_EXPIRATION_DATE"]
    raw = local(spark, M.schema(**{n: M.STRING for n in names}), V.crosswalk_rows())
    return raw.withColumn("MAPPING_EXPIRATION_DATE", F.col("MAPPING_EXPIRATION_DATE").cast("date"))


def level_map(spark: SparkSession, kind: str, generation: int) -> DataFrame:
    return local(spark, M.schema(subcode=M.STRING, **{f"{kind}lev": M.STRING}), V.levels(kind, generation))


def drug_map(spark: SparkSession) -> DataFrame:
    return local(spark, M.DRUG_MAP, V.DRUG_NAMES)


def fees(spark: SparkSession) -> DataFrame:
    return local(spark, M.FEE, V.fee_rows())


def drug_prices(spark: SparkSession) -> DataFrame:
    return local(spark, M.DRUG_PRICE, [(n, c, f"ndc-{n}-{p}", p) for n, c, p in V.DRUG_PRICES])


def gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Annotations: services of 1998 with a metric code."""
    owner: dict[str, str] = {}
    for _, metric, _, code in sorted(r for r in V.RULES[10] if r[0] == "service" and r[2] == "CPT"):
        owner[code] = min(metric, owner.get(code, metric))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    lines = table(spark, sf_dir, "lineitem").filter(
        (F.col("l_shipdate") >= "1998-01-01") & (F.col("l_shipdate") < "1999-01-01"))
    code = pick(V.PROCEDURES, F.col("l_partkey") % len(V.PROCEDURES))
    metric = F.element_at(F.create_map(*[F.lit(x) for pair in sorted(owner.items()) for x in pair]), code)
    day = F.col("l_shipdate")
    return (
        lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .withColumn("metric", metric)
        .filter(F.col("metric").isNotNull())
        .select(
            F.concat(F.lit("CW_"), "metric").alias("Metric"),
            mrn(F.col("o_custkey")).alias("MRN"),
            code.alias("TEST_CODE"),
            day.cast("date").alias("TEST_DATE_a"),
            dates.month_label(day).alias("TEST_DATE_month"),
            F.when(F.col("l_linenumber") == 7, "See comment").when(F.col("l_quantity") >= 25, "Numer")
            .otherwise("Not_Numer").alias("Term_assessed"),
            F.lit("Y").alias("Gold_Standard"),
        )
    )


def wide_crosswalk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A crosswalk that grows with the data: part/supplier pairs as code pairs."""
    part, supp = F.col("l_partkey"), F.col("l_suppkey")
    ten = F.concat(pick([chr(65 + i) for i in range(26)], part % 26), F.lpad((part % 100).cast("string"), 2, "0"),
                   F.lit("."), part.cast("string"), F.when(part % 4 == 0, "x").otherwise(""))
    nine = F.concat(F.lpad((supp % 1000).cast("string"), 3, "0"), F.lit("."), (supp % 7).cast("string"))
    return (
        table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey").distinct()
        .select(
            nine.alias("ICD9_CODE"), ten.alias("ICD10_CODE"),
            codes.strip_dots(nine).alias("ICD9_subcode"), codes.strip_dots(ten).alias("ICD10_subcode"),
            F.when(supp % 10 == 0, "ICD_9_PROC_CODE").otherwise("ICD_9_CM_CODE").alias("ICD9_TYPE"),
            F.when(part % 10 == 0, "ICD10PCS_CODE").otherwise("ICD10CM_CODE").alias("ICD10_TYPE"),
            F.concat(F.lit("nine "), nine).alias("ICD9_DESC"), F.concat(F.lit("ten "), ten).alias("ICD10_DESC"),
            F.when((part + supp) % 5 == 0, "Approximate").otherwise("Equal").alias("RELATION_TYPE"),
            F.when((part + supp) % 7 == 0, F.lit("2014-09-30").cast("date")).alias("MAPPING_EXPIRATION_DATE"),
        )
    )
