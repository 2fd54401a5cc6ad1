"""The fixture tables seen as raw feeds and as facts.

Every function renames and derives columns of whole fixture tables so that the engine's plans,
which expect feeds and facts, run on them unchanged. Nothing is sampled or filtered to save work;
NULLs are made with conditions on columns because the fixture tables have none.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from jobtide.fixed_values import LINKEDIN, LINKEDIN_LARGE, LIVE, MACRO_SERIES, METRO_KEY, METRO_VARIABLES
from jobtide.operators.joins import match_titles
from jobtide.plans import dimensions
from jobtide.plans.postings import title_to_soc


_SCHEMAS: dict[str, T.StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan of a fixture table. The schema is read from the footer once per path."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def source_of(status: str) -> Column:
    """Order or line status as one of three posting sources."""
    return (
        F.when(F.col(status) == "F", LINKEDIN)
        .when(F.col(status) == "O", LINKEDIN_LARGE)
        .otherwise(LIVE)
    )


def nation_code() -> Column:
    """A nation as an occupation code; the region gives the major group 11, 13, 15, 17 or 19."""
    group = (F.col("n_regionkey") * 2 + 11).cast("string")
    return F.concat(group, F.lit("-"), F.lpad(F.col("n_nationkey").cast("string"), 4, "0"), F.lit(".00"))


def text_of(number: str) -> Column:
    return F.col(number).cast("string")


# --- occupation database ------------------------------------------------------------------


def occupations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(
        nation_code().alias("O*NET-SOC Code"),
        F.concat(F.lit(" Occupation "), "n_name", F.lit(" ")).alias("Title"),
        F.concat(F.lit("Work of "), "n_name").alias("Description"),
    )


def job_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "nation").select(
        nation_code().alias("O*NET-SOC Code"), (F.col("n_regionkey") + 1).alias("Job Zone")
    )


def alternate_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segment and nation of all customers; two of the five segments go by a title that no posting has."""
    people = table(spark, sf_dir, "customer").select(
        "c_mktsegment", F.col("c_nationkey").alias("n_nationkey")).distinct()
    other = F.when(F.col("c_mktsegment").isin("HOUSEHOLD", "MACHINERY"), "other")
    return people.join(table(spark, sf_dir, "nation"), "n_nationkey").select(
        nation_code().alias("O*NET-SOC Code"),
        F.concat_ws(" ", other, "c_mktsegment", "n_name").alias("Alternate Title"),
        F.col("c_mktsegment").alias("Short Title"),
    )


def lines_by_supplier_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_nationkey").alias("n_nationkey"))
    nation = supplier.join(table(spark, sf_dir, "nation"), "n_nationkey").select(
        F.col("s_suppkey").alias("l_suppkey"), nation_code().alias("O*NET-SOC Code")
    )
    part = table(spark, sf_dir, "part").withColumnRenamed("p_partkey", "l_partkey")
    return table(spark, sf_dir, "lineitem").join(nation, "l_suppkey").join(part, "l_partkey")


def ratings(spark: SparkSession, sf_dir: str, element: str = "p_name") -> DataFrame:
    """Lines as ratings: return flag A is importance, N is level, R a third scale."""
    flag = F.col("l_returnflag")
    return lines_by_supplier_nation(spark, sf_dir).select(
        "O*NET-SOC Code",
        F.concat(F.lit(" "), F.upper(element)).alias("Element ID"),
        F.initcap(element).alias("Element Name"),
        F.when(flag == "A", "IM").when(flag == "N", "LV").otherwise("XX").alias("Scale ID"),
        F.col("l_extendedprice").alias("Data Value"),
        F.when(F.col("l_linestatus") == "O", "N").when(F.col("l_quantity") > 25, "Y")
        .alias("Recommend Suppress"),
    )


def technology(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as the tools of the nations that supply them; all but one brand go by a name of their own."""
    own = F.when(F.col("p_brand") != "Brand#1", F.col("p_brand"))
    return lines_by_supplier_nation(spark, sf_dir).select(
        "O*NET-SOC Code",
        F.concat_ws(" ", F.initcap("p_name"), own).alias("Example"),
        F.col("p_size").cast("bigint").alias("Commodity Code"),
        F.concat(F.lit(" "), "p_type").alias("Commodity Title"),
        F.when(F.col("p_size") > 40, "?").when(F.col("p_size") > 20, "Y").otherwise("N").alias("Hot Technology"),
        F.when(F.col("p_type") == "PROMO", "Y").otherwise("N").alias("In Demand"),
    ).distinct()


def education(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as education ratings of the customer's nation: the month is the category."""
    return orders_with_places(spark, sf_dir).select(
        nation_code().alias("O*NET-SOC Code"),
        F.lit("2.D.1").alias("Element ID"),
        F.concat(F.lit(" "), "o_orderpriority").alias("Element Name"),
        F.when(F.col("c_mktsegment") == "HOUSEHOLD", "PT").otherwise("RL").alias("Scale ID"),
        F.month("o_orderdate").alias("Category"),
        F.col("o_totalprice").alias("Data Value"),
        F.when(F.col("o_orderstatus") == "P", "Y").otherwise("N").alias("Recommend Suppress"),
    )


def education_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Months that occur, described for all priorities; three of the five under a name that no rating has."""
    other = F.when(~F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "other")
    return table(spark, sf_dir, "orders").select(
        F.lit("2.D.1").alias("Element ID"),
        F.concat_ws(" ", other, "o_orderpriority").alias("Element Name"),
        F.lit("RL").alias("Scale ID"),
        F.month("o_orderdate").cast("string").alias("Category"),
        F.lit("described").alias("Category Description"),
    ).distinct()


# --- places and companies -----------------------------------------------------------------


def orders_with_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with their customer, nation and region."""
    nation = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region").withColumnRenamed("r_regionkey", "n_regionkey"), "n_regionkey"
    )
    customer = table(spark, sf_dir, "customer").join(
        nation.withColumnRenamed("n_nationkey", "c_nationkey"), "c_nationkey"
    ).withColumnRenamed("c_nationkey", "n_nationkey")
    return table(spark, sf_dir, "orders").join(
        customer.withColumnRenamed("c_custkey", "o_custkey"), "o_custkey"
    )


def metro_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as metros; their figures are shifted customer balances, one of them unreadable."""
    rich = table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(
        F.floor(F.max("c_acctbal")).cast("bigint").alias("high")
    )
    nation = table(spark, sf_dir, "nation").join(rich, F.col("n_nationkey") == F.col("c_nationkey"))
    figures = [
        (F.when(F.col("n_regionkey") == 4, F.lit("(X)")).otherwise(
            (F.col("high") + shift).cast("string")) if shift == 2
         else (F.col("high") + shift).cast("string")).alias(code)
        for shift, (code, _, _) in enumerate(METRO_VARIABLES)
    ]
    return nation.select(
        F.concat(F.lit(" "), "n_name").alias("NAME"), *figures, text_of("n_nationkey").alias(METRO_KEY)
    )


def metro_bridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations of three regions as (state, city) of a metro."""
    nation = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    return nation.where(F.col("r_name").isin("AMERICA", "ASIA", "EUROPE")).select(
        F.col("r_name").alias("state"), F.col("n_name").alias("city"),
        F.col("n_nationkey").alias("cbsa_fips"),
    )


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """City and county per nation, repeated for every nation of the region as its state."""
    nation = table(spark, sf_dir, "nation")
    states = nation.select("n_regionkey", F.col("n_name").alias("state_full"))
    region = table(spark, sf_dir, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    return nation.join(states, "n_regionkey").join(region, "n_regionkey").select(
        F.col("n_name").alias("city"),
        F.concat("r_name", F.lit(" County")).alias("county"),
        "state_full",
    )


def companies(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").join(
        table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")
    ).select(
        F.col("s_suppkey").alias("company_id"),
        F.concat(F.lit("  "), "s_name").alias("name"),
        F.concat(F.lit("About "), "s_name", F.lit(" ")).alias("description"),
        F.col("n_regionkey").cast("double").alias("company_size"),
        F.col("n_name").alias("city"),
        F.concat(F.lit("State "), text_of("n_regionkey")).alias("state"),
        F.lit("US").alias("country"),
        text_of("s_nationkey").alias("zip_code"),
        F.concat(F.lit("http://"), "s_name").alias("url"),
    )


def lines_with_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "part").withColumnRenamed("p_partkey", "l_partkey"), "l_partkey"
    )


def company_industries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines_with_parts(spark, sf_dir).select(
        F.col("l_suppkey").alias("company_id"), F.concat(F.lit(" "), "p_brand").alias("industry")
    )


def company_specialties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part types of the large lines; small lines have a blank."""
    return lines_with_parts(spark, sf_dir).select(
        F.col("l_suppkey").alias("company_id"),
        F.when(F.col("l_quantity") > 49, F.col("p_type")).otherwise(" ").alias("speciality"),
    )


def employee_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("company_id"),
        F.when(F.col("l_returnflag") != "R", F.col("l_quantity").cast("bigint")).alias("employee_count"),
        F.col("l_linenumber").cast("bigint").alias("follower_count"),
        F.unix_date(F.col("l_shipdate").cast("date")).cast("bigint").alias("time_recorded"),
    )


# --- posting feeds ------------------------------------------------------------------------


def linkedin_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    urgent = F.col("o_orderpriority")
    return orders_with_places(spark, sf_dir).select(
        F.col("o_orderkey").alias("job_id"),
        F.concat(F.lit(" "), "c_mktsegment", F.lit(" "), "n_name").alias("title"),
        F.concat(F.lit(" Order of "), "c_name", F.lit(" ")).alias("description"),
        F.concat_ws(", ", "n_name", "r_name").alias("location"),
        F.col("c_name").alias("company_name"),
        F.col("o_custkey").cast("double").alias("company_id"),
        F.upper("o_orderpriority").alias("work_type"),
        F.col("o_orderpriority").alias("formatted_work_type"),
        F.col("c_mktsegment").alias("formatted_experience_level"),
        F.when(urgent == "5-LOW", F.lit(0)).otherwise(
            F.unix_date(F.col("o_orderdate").cast("date")) * F.lit(86400000).cast("bigint")
        ).cast("double").alias("listed_time"),
        F.when(urgent == "1-URGENT", 1.0).when(urgent == "2-HIGH", 0.0).alias("remote_allowed"),
        F.floor(F.col("o_totalprice")).cast("double").alias("views"),
        F.when(F.col("o_orderstatus") == "F", F.col("n_nationkey").cast("double")).alias("applies"),
    )


def linkedin_salaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as salary rows: the return flag is the period, every fifth line states a small amount."""
    flag, amount = F.col("l_returnflag"), F.col("l_extendedprice")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_partkey").alias("salary_id"),
        F.col("l_orderkey").alias("job_id"),
        F.when(flag != "R", amount).alias("max_salary"),
        F.when(F.col("l_linenumber") == 5, F.col("l_quantity") * 50).alias("med_salary"),
        F.when(flag != "A", amount * (1 - F.col("l_discount"))).alias("min_salary"),
        F.when(flag == "A", "MONTHLY").when(flag == "N", "WEEKLY").otherwise("HOURLY").alias("pay_period"),
        F.when(F.col("l_linestatus") == "O", "usd").when(F.col("l_tax") > 0.04, "EUR").otherwise("USD")
        .alias("currency"),
    )


def linkedin_job_skills(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("job_id"), text_of("l_partkey").alias("skill_abr")
    )


def mapping_skills(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Part names as skill names; the small parts have none."""
    return table(spark, sf_dir, "part").select(
        text_of("p_partkey").alias("skill_abr"),
        F.when(F.col("p_size") > 3, F.initcap("p_name")).alias("skill_name"),
    )


def listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as listings."""
    source, lang = F.col("source"), F.col("lang")
    return table(spark, sf_dir, "documents").select(
        F.concat(F.lit(" "), text_of("doc_id")).alias("job_link"),
        F.when(source == "src3", " ").otherwise(F.concat_ws(" ", source, lang)).alias("job_title"),
        F.upper(source).alias("company"),
        F.concat(lang, F.lit(", remote ")).alias("job_location"),
        F.when(lang == "de", "Senior").otherwise("Mid").alias("job_level"),
        F.when(lang == "fr", "Remote").when(lang != "en", "Onsite").alias("job_type"),
        F.concat(F.lit("Role "), lang).alias("search_position"),
        F.lit("Austin").alias("search_city"),
        F.lit("US").alias("search_country"),
        F.when(source == "src5", "soon").when(source == "src6", " ").otherwise(
            F.concat(F.lit(" 2024-01-"), F.lpad(F.replace(source, F.lit("src")), 2, "0")))
        .alias("first_seen"),
    )


def listing_skills(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(
        text_of("doc_id").alias("job_link"), F.col("text").alias("job_skills")
    )


def turn_skills(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversation turns as skill lists; a conversation has several."""
    return table(spark, sf_dir, "conversations").select(
        text_of("conv_id").alias("job_link"), F.col("text").alias("job_skills")
    )


def listing_summaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "labels").select(
        text_of("doc_id").alias("job_link"),
        F.when(F.col("quality") == 1, F.concat(F.lit(" quality "), text_of("quality"))).otherwise("")
        .alias("job_summary"),
    )


def live_postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as fetched live postings: the customer is the id, so ids repeat."""
    priority = F.col("o_orderpriority")
    place = (
        F.when(priority == "1-URGENT", "US")
        .when(priority == "2-HIGH", F.concat_ws(", ", "n_name", "n_name"))
        .when(priority == "3-MEDIUM", F.concat(F.lit('"'), "n_name", F.lit('", '), "r_name", F.lit(" County")))
        .when(priority == "5-LOW", F.concat("n_name", F.lit(", Nowhere County")))
        .otherwise(F.col("n_name"))
    )
    return orders_with_places(spark, sf_dir).select(
        text_of("o_custkey").alias("id"),
        F.concat_ws(" ", "c_mktsegment", "o_orderkey").alias("title"),
        F.concat(F.lit(" Order "), text_of("o_orderkey")).alias("description"),
        F.when(F.col("o_orderstatus") == "F", "Full_Time").alias("contract_time"),
        (F.col("o_totalprice") / 2).alias("salary_min"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("salary_max"),
        F.col("n_nationkey").cast("double").alias("latitude"),
        F.col("n_regionkey").cast("double").alias("longitude"),
        place.alias("location.display_name"),
        F.col("c_name").alias("company.display_name"),
        F.col("c_mktsegment").alias("category.label"),
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("created"),
    )


# --- series -------------------------------------------------------------------------------


def labor_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as observations of two known series and an unknown one."""
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    month = F.concat(F.lit("M"), F.lpad(F.month("o_orderdate").cast("string"), 2, "0"))
    net = F.col("o_totalprice") - 1000
    return table(spark, sf_dir, "orders").select(
        F.when(status == "F", " LNS12300060").when(status == "O", "JTS000000000000000HIR")
        .otherwise("UNKNOWN1").alias("seriesID"),
        F.year("o_orderdate").cast("string").alias("year"),
        F.when(priority == "5-LOW", "M13").when(priority == "2-HIGH", "S01").otherwise(month).alias("period"),
        F.date_format("o_orderdate", "MMMM").alias("periodName"),
        F.when((priority == "3-MEDIUM") & (status == "P"), "-").otherwise(
            F.col("o_totalprice").cast("string")).alias("value"),
        F.lit("false").alias("latest"),
        net.cast("string").alias("calculations.net_changes.1"),
        F.lit("n/a").alias("calculations.net_changes.12"),
        text_of("o_custkey").alias("calculations.pct_changes.1"),
        F.when(status == "F", "1.5").alias("calculations.pct_changes.12"),
    )


def macro_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as daily rows with a column per series; five of them carry numbers."""
    values = {
        "UNRATE": F.col("l_quantity"),
        "CPIAUCSL": F.col("l_extendedprice"),
        "ICSA": F.nullif(F.col("l_discount"), F.lit(0.0)),
        "LNS12300060": F.when(F.col("l_returnflag") == "A", F.col("l_extendedprice")),
        "DFF": F.col("l_tax"),
    }
    return table(spark, sf_dir, "lineitem").select(
        F.when(F.col("l_linenumber") < 7, F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss")).alias("date"),
        *[values.get(s, F.lit(None).cast("double")).alias(s) for s, _ in MACRO_SERIES],
    )


# --- facts --------------------------------------------------------------------------------


def titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return title_to_soc(alternate_titles(spark, sf_dir), occupations(spark, sf_dir))


def postings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as the postings fact."""
    priority = F.col("o_orderpriority")
    rows = orders_with_places(spark, sf_dir).select(
        text_of("o_orderkey").alias("posting_id"),
        F.lower(F.concat_ws(" ", "c_mktsegment", "n_name")).alias("job_title"),
        F.lower("c_name").alias("company_name"),
        F.lower("c_mktsegment").alias("experience_level"),
        F.nullif(F.lower(priority), F.lit("5-low")).alias("work_type"),
        F.when(priority != "4-NOT SPECIFIED", F.col("o_orderdate")).alias("posted_at"),
        F.when(priority != "5-LOW", F.round("o_totalprice").cast("int")).alias("annual_salary_estimate"),
        F.when(priority != "4-NOT SPECIFIED", priority == "1-URGENT").alias("is_remote"),
        (F.col("o_orderstatus") == "O").alias("is_snapshot"),
        source_of("o_orderstatus").alias("data_source"),
        F.nullif(F.col("r_name"), F.lit("AFRICA")).alias("state"),
        F.col("n_name").alias("city"),
    )
    return match_titles(rows, titles(spark, sf_dir))


def skills(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as the posting × skill fact."""
    return lines_with_parts(spark, sf_dir).select(
        text_of("l_orderkey").alias("posting_id"),
        F.lower("p_name").alias("skill_name"),
        source_of("l_linestatus").alias("data_source"),
    ).distinct()


def labor_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as labor observations."""
    status = F.col("o_orderstatus")
    name = F.when(status == "F", "unemployment rate").when(status == "O", "jolts hires").otherwise("unlisted")
    return table(spark, sf_dir, "orders").select(
        status.alias("series_id"),
        name.alias("series_name"),
        F.col("o_orderdate").cast("date").alias("observation_date"),
        F.col("o_totalprice").alias("value"),
        (F.col("o_orderpriority") == "5-LOW").alias("is_annual_average"),
    )


def macro_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines as macro observations; status F overlaps with the labor series, returns do not."""
    flag = F.when(F.col("l_linestatus") == "F", "F").otherwise(F.col("l_returnflag"))
    return table(spark, sf_dir, "lineitem").select(
        flag.alias("series_id"),
        F.when(flag == "A", "consumer price index").when(flag == "N", "retail sales ex food services")
        .otherwise("unemployed less than 5 weeks").alias("series_name"),
        F.col("l_shipdate").cast("date").alias("observation_date"),
        F.col("l_extendedprice").alias("value"),
    )


# --- dimensions needed by the marts ---------------------------------------------------------


def dim_occupations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.dim_occupations(occupations(spark, sf_dir), job_zones(spark, sf_dir))


def dim_education(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.dim_education_requirements(
        education(spark, sf_dir), education_categories(spark, sf_dir))


def dim_skills(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.dim_ratings(ratings(spark, sf_dir))


def dim_technology(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.dim_technology_skills(technology(spark, sf_dir))


def dim_metros(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dimensions.dim_metros(metro_profiles(spark, sf_dir))
