"""The given tables seen as the inputs of the reports.

Each role is a projection over whole tables, in SQL that Spark and DuckDB share:
the same text builds the Spark view and the oracle's common table expression.
Ids that do not match anything are null keys, so no role drops rows of its table.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from rapport.schemas import struct

AS_OF = dt.date(2024, 1, 30)
CALENDAR_START = dt.date(2024, 1, 1)
REPORT_START = dt.date(2024, 1, 15)
PREFIX = "GA_"
HOME_STATE = "GA"

BASE = {
    "region": struct(r_regionkey="int", r_name="string"),
    "nation": struct(n_nationkey="int", n_name="string", n_regionkey="int"),
    "customer": struct(
        c_custkey="bigint", c_name="string", c_nationkey="int", c_acctbal="double", c_mktsegment="string"
    ),
    "part": struct(
        p_partkey="bigint", p_name="string", p_brand="string", p_type="string", p_size="int", p_retailprice="double"
    ),
    "orders": struct(
        o_orderkey="bigint",
        o_custkey="bigint",
        o_orderstatus="string",
        o_totalprice="double",
        o_orderdate="timestamp_ntz",
        o_orderpriority="string",
    ),
    "lineitem": struct(
        l_orderkey="bigint",
        l_partkey="bigint",
        l_suppkey="bigint",
        l_linenumber="int",
        l_quantity="double",
        l_extendedprice="double",
        l_discount="double",
        l_tax="double",
        l_returnflag="string",
        l_linestatus="string",
        l_shipdate="timestamp_ntz",
    ),
    "events": struct(
        event_id="bigint", ts="timestamp_ntz", user_id="bigint", event_type="string", value="double", props="string"
    ),
}

ROLES = {
    "r_users": """
        SELECT c_custkey AS user_id, split_part(c_name, '#', 1) AS first_name,
          CASE WHEN c_acctbal > 9800 THEN NULL ELSE split_part(c_name, '#', 2) END AS last_name,
          concat('user', cast(c_custkey AS varchar(20)), '@example.org') AS email_address,
          cast(30000 + c_nationkey AS varchar(20)) AS zip_code,
          CASE c_mktsegment WHEN 'BUILDING' THEN 'GA' WHEN 'MACHINERY' THEN NULL ELSE 'NY' END AS state,
          cast(4040000000 + CASE c_mktsegment WHEN 'HOUSEHOLD' THEN c_custkey - c_custkey % 2 ELSE c_custkey END
            AS varchar(20)) AS phone_number,
          cast(date '2023-12-29' + cast(c_custkey % 34 AS int) AS date) AS date_joined,
          lower(c_mktsegment) AS role, 'link' AS added_method, cast(c_nationkey AS varchar(20)) AS invite_code,
          concat('code ', cast(c_nationkey AS varchar(20))) AS invite_code_name,
          CASE WHEN c_acctbal > 0 THEN c_custkey - 1 END AS added_by_user_id
        FROM {customer}""",
    "r_training": """
        SELECT c_custkey AS row_no, c_name AS cm_name,
          concat('cm', cast(c_custkey AS varchar(20)), '@example.org') AS email_address,
          CASE WHEN c_mktsegment = 'MACHINERY' THEN NULL WHEN c_acctbal > 9500 THEN 'NO CODE'
            ELSE concat('  ', n_name, ' ') END AS invite_code,
          CASE WHEN c_acctbal < -800 THEN NULL WHEN c_acctbal < -600 THEN '555-01'
            WHEN c_acctbal < 0 THEN concat('999 ', cast(1000000 + c_custkey AS varchar(20)))
            WHEN c_mktsegment = 'HOUSEHOLD' THEN concat('+1 (40) ', cast(40000000 + c_custkey - c_custkey % 2 AS varchar(20)))
            ELSE concat('1-40.', cast(40000000 + c_custkey AS varchar(20))) END AS phone_number
        FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey""",
    "r_leaders": """
        SELECT n_name AS invite_code, n_name AS rmm, r_name AS pod, concat(lower(n_name), '@example.org') AS rmm_email
        FROM {nation} JOIN {region} ON n_regionkey = r_regionkey""",
    "r_relationships": """
        SELECT o_custkey AS user_id, concat('user ', cast(o_custkey AS varchar(20))) AS user_name, l_partkey AS reach_id,
          o_orderpriority AS relationship_type,
          CASE WHEN o_orderstatus = 'P' THEN 'Inactive' ELSE 'Active' END AS relationship_status,
          cast(date '2023-12-28' + cast(o_orderkey % 33 AS int) AS date) AS relationship_created_date,
          cast(cast(date '2023-12-28' + cast(o_orderkey % 33 AS int) AS date) AS timestamp)
            + interval '1' hour * l_linenumber AS relationship_created_timestamp,
          CASE WHEN l_partkey % 5 = 0 THEN 'Reach Add' ELSE 'Voter' END AS auto_applied_tag,
          CASE WHEN l_partkey % 5 <> 0 THEN concat('GA_', cast(l_partkey AS varchar(20))) END AS state_file_id,
          CASE WHEN l_returnflag = 'N' THEN 'Pat' ELSE 'pat' END AS person_first_name,
          cast(l_partkey AS varchar(20)) AS person_last_name
        FROM {orders} JOIN {lineitem} ON l_orderkey = o_orderkey""",
    "r_responses": """
        SELECT user_id, user_id * 13 + event_id % 17 AS reach_id, event_type AS question_id, event_type AS question_name,
          CASE WHEN event_id % 11 = 0 THEN NULL ELSE event_id END AS response_id,
          CASE WHEN event_id % 19 = 0 THEN NULL WHEN event_type IN ('purchase', 'signup') THEN
            concat('["', CASE event_id % 6 WHEN 0 THEN 'Strong yes' WHEN 1 THEN 'Lean yes' WHEN 2 THEN 'Undecided'
              WHEN 3 THEN 'Lean no' WHEN 4 THEN 'Strong no' ELSE 'Not Voting' END, '","',
              CASE event_id % 4 WHEN 0 THEN 'Strong yes' WHEN 1 THEN 'Undecided' WHEN 2 THEN 'Strong no'
              ELSE 'Not Voting' END, '"]')
            ELSE cast(event_id % 7 AS varchar(20)) END AS response_value,
          cast(ts AS date) AS canvass_date, cast(cast(ts AS date) AS timestamp) AS canvass_timestamp,
          concat('GA_', cast(user_id * 13 + event_id % 17 AS varchar(20))) AS state_file_id
        FROM {events}""",
    "r_contact_actions": """
        SELECT user_id, user_id * 13 + event_id % 17 AS reach_id, event_type AS action_type,
          cast(ts AS date) AS action_date, cast(cast(ts AS date) AS timestamp) AS action_timestamp,
          'Sam' AS person_first_name, event_type AS person_last_name,
          CASE WHEN event_id % 3 <> 0 THEN concat('GA_', cast(user_id * 13 + event_id % 17 AS varchar(20))) END
            AS state_file_id
        FROM {events}""",
    "r_tag_history": """
        SELECT user_id, user_id * 13 + event_id % 17 AS reach_id, event_id,
          CASE WHEN event_id % 13 <> 0 THEN concat('GA_', cast(user_id * 13 + event_id % 17 AS varchar(20))) END
            AS state_file_id,
          concat('t', cast(event_id % 5 AS varchar(20))) AS tag_id,
          CASE event_id % 5 WHEN 0 THEN 'early_voted' WHEN 1 THEN 'ballot_received' WHEN 2 THEN 'ballot_mailed'
            WHEN 3 THEN 'request_received' ELSE 'other' END AS tag_name,
          CASE WHEN user_id % 3 = 0 THEN 'Removed' ELSE 'Added' END AS tag_action,
          cast(ts AS date) AS tag_date, cast(cast(ts AS date) AS timestamp) AS tag_timestamp
        FROM {events}""",
    "r_voter_file": """
        SELECT cast(p_partkey AS varchar(20)) AS sos_id, p_partkey + 1000000 AS person_id,
          p_partkey + 2000000 AS myv_van_id, CASE WHEN p_partkey % 11 <> 0 THEN p_partkey END AS master_registration_id,
          split_part(p_name, ' ', 1) AS first_name, p_type AS middle_name,
          concat(lower(p_brand), '-', split_part(p_name, ' ', 2)) AS last_name,
          cast(18 + p_size AS varchar(20)) AS age_combined, CASE WHEN p_size < 25 THEN 'F' ELSE 'M' END AS gender_combined,
          CASE WHEN p_size < 40 THEN cast(4050000000 + p_partkey AS varchar(20)) END AS primary_phone_number,
          concat(cast(p_size AS varchar(20)), ' Main St') AS voting_street_address,
          cast(NULL AS varchar(20)) AS voting_street_address_2, p_type AS voting_city, 'GA' AS state_code,
          cast(30300 + p_size AS varchar(20)) AS voting_zip, cast(floor(p_partkey / 3) AS bigint) AS voting_address_id,
          cast(floor(p_partkey / 2) AS bigint) AS household_id, p_size > 5 AS reg_on_current_file
        FROM {part}""",
    "r_crosswalk": """
        SELECT p_partkey AS reach_id, CASE WHEN p_partkey % 5 <> 0 THEN cast(p_partkey AS varchar(20)) END AS sos_id
        FROM {part}""",
    "r_absentee": """
        SELECT CASE WHEN p_partkey % 3 <> 0 THEN p_partkey + 2000000 END AS myv_van_id,
          CASE WHEN p_partkey % 7 = 0 THEN cast(date '2024-01-05' + cast(p_partkey % 25 AS int) AS date) END
            AS date_early_voted,
          CASE WHEN p_partkey % 8 = 0 THEN cast(date '2024-01-06' + cast(p_partkey % 20 AS int) AS date) END
            AS date_ballot_received,
          CASE WHEN p_partkey % 4 = 0 THEN date '2024-01-03' END AS date_ballot_mailed,
          CASE WHEN p_partkey % 2 = 0 THEN date '2024-01-02' END AS date_request_received
        FROM {part}""",
    "r_scores": """
        SELECT CASE WHEN p_partkey % 10 <> 9 THEN p_partkey + 1000000 END AS person_id,
          cast(p_partkey % 101 AS double) / 100 AS modeled_support_score,
          CASE WHEN p_partkey % 6 = 0 THEN NULL ELSE cast(p_partkey % 11 AS double) / 10 END AS gotv_score,
          cast(p_size * 2 AS double) AS model_support_score
        FROM {part}""",
    "r_external": """
        SELECT user_id * 13 + event_id % 17 + 1000000 AS person_id, user_id * 13 + event_id % 17 + 2000000 AS myv_van_id,
          event_type AS master_survey_question_id, concat('r', cast(event_id % 4 AS varchar(20))) AS master_survey_response_id,
          event_type AS survey_question_id, concat('r', cast(event_id % 6 AS varchar(20))) AS survey_response_id,
          cast(cast(ts AS date) AS timestamp) AS datetime_canvassed,
          CASE WHEN event_id % 3 = 0 THEN 1 ELSE 0 END AS msq_currency,
          CASE WHEN event_id % 4 = 0 THEN 1 ELSE 0 END AS sq_currency
        FROM {events}""",
    "r_election": """
        SELECT user_id * 13 + event_id % 17 AS registration_id, event_type AS election_id FROM {events}""",
    "r_people": """
        SELECT CASE WHEN p_size <> 7 THEN concat('GA_', cast(p_partkey AS varchar(20))) END AS state_file_id,
          CASE WHEN p_size > 30 THEN cast(4060000000 + p_partkey AS varchar(20)) END AS phone
        FROM {part}""",
    "r_phones": """
        SELECT p_partkey + 2000000 AS myv_van_id,
          CASE WHEN p_size % 4 = 0 THEN cast(4070000000 + p_partkey AS varchar(20)) END AS phone_number
        FROM {part}""",
    "r_tag_log": """
        SELECT concat('GA_', cast(p_partkey AS varchar(20))) AS alloy_sos_id,
          CASE WHEN p_size <= 10 THEN 'ballot_mailed' WHEN p_size <= 20 THEN 'request_received'
            WHEN p_size <= 30 THEN 'early_voted' ELSE 'other' END AS voting_status
        FROM {part}""",
    "r_notes": """
        SELECT c_custkey + 3000000 AS myc_van_id,
          CASE WHEN c_acctbal > -500 THEN c_custkey END AS note_text,
          CASE WHEN c_mktsegment = 'BUILDING' THEN 'Other' ELSE 'User ID' END AS note_category_name
        FROM {customer}""",
    "r_records": """
        SELECT c_custkey + 3000000 AS myc_van_id, c_custkey + 2000000 AS myv_van_id FROM {customer}""",
}

# Flat rows as they come out of the nested documents; {members} is the matched member list.
FLAT = """
    SELECT m.pod, m.rmm, cast(m.user_id AS varchar(20)) AS user_id, m.date_joined, m.user_name, m.email_address,
      m.phone_number, cast(m.user_id % 10 AS varchar(20)) AS last_activity,
      CASE WHEN m.user_id % 4 = 0 THEN 'Has Voted!' ELSE 'Needs to Vote' END AS cm_voting_status,
      concat('person ', cast(e.reach_id AS varchar(20))) AS voter,
      CASE e.reach_id % 3 WHEN 0 THEN 'Strong yes' WHEN 1 THEN 'Undecided' ELSE '' END AS support_id,
      CASE e.reach_id % 3 WHEN 0 THEN cast(1 + e.reach_id % 5 AS varchar(20)) WHEN 1 THEN '3' ELSE '' END
        AS support_id_numeric,
      CASE WHEN e.reach_id % 4 = 1 THEN 'Early in-person' ELSE '' END AS vote_plan, '' AS detailed_plan,
      CASE WHEN e.reach_id % 9 = 0 THEN 'Yes' ELSE '' END AS vol_ask, '' AS triplers, '' AS outreach,
      CASE WHEN e.reach_id % 5 = 0 THEN 'Reach Add' ELSE cast(e.reach_id AS varchar(20)) END AS sos_id,
      cast(1 + e.reach_id % 4 AS varchar(20)) AS tier,
      CASE WHEN e.reach_id % 4 = 3 THEN 'Not a Target' ELSE concat('Tier ', cast(1 + e.reach_id % 4 AS varchar(20))) END
        AS tier_str,
      CASE WHEN e.reach_id % 5 = 0 THEN '' WHEN e.reach_id % 7 < 3 THEN 'Has Voted!' ELSE 'Needs to Vote' END
        AS voting_status
    FROM (SELECT DISTINCT user_id, reach_id FROM {relationships} WHERE relationship_status = 'Active') e
    JOIN {members} m ON e.user_id = m.user_id"""
VOLUNTEERS = """
    SELECT cast(u.user_id AS varchar(20)) AS user_id, concat_ws(' ', u.first_name, u.last_name) AS user_name,
      u.phone_number, u.date_joined, u.zip_code, coalesce(u.state, '') AS state,
      cast(e.reach_id AS varchar(20)) AS reach_id,
      e.auto_applied_tag, 'Pat' AS person_first_name, cast(e.reach_id AS varchar(20)) AS person_last_name,
      CASE e.reach_id % 3 WHEN 0 THEN 'Strong yes' WHEN 1 THEN 'Undecided' ELSE '' END AS support_id,
      CASE WHEN e.reach_id % 4 = 1 THEN 'Early in-person' ELSE '' END AS vote_plan, '' AS detailed_plan,
      CASE WHEN e.reach_id % 9 = 0 THEN 'Yes' ELSE '' END AS vol_ask,
      CASE WHEN e.reach_id % 5 = 0 THEN '' WHEN e.reach_id % 7 < 3 THEN 'Has Voted!' ELSE 'Needs to Vote' END
        AS voting_status,
      CASE WHEN e.reach_id % 10 = 3 THEN 'y' ELSE 'n' END AS only_reachable_by_reacher, '' AS triplers,
      cast(1 + e.reach_id % 4 AS varchar(20)) AS tier
    FROM (SELECT DISTINCT user_id, reach_id, auto_applied_tag FROM {relationships}) e
    JOIN {users} u ON e.user_id = u.user_id"""


class Tables:
    """Base tables and roles of one data folder as DataFrames."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root

    def __getattr__(self, name: str) -> DataFrame:
        if name in BASE:
            df = self.spark.read.schema(BASE[name]).parquet(f"{self.root}/{name}.parquet")
        elif f"r_{name}" in ROLES:
            text = ROLES[f"r_{name}"]
            df = self.spark.sql(text, **{t: getattr(self, t) for t in BASE if "{" + t + "}" in text})
        else:
            raise AttributeError(name)
        setattr(self, name, df)
        return df


def role_sql(name: str) -> str:
    """A role's text over the plain table names."""
    return ROLES[name].format(**{t: t for t in BASE})
