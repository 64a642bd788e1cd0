"""Schemas of the tables that the package reads and writes. Column order is part of the contract."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

TECH_STACK = "struct<cms:array<string>,pageBuilder:array<string>,analytics:array<string>,tracking:array<string>,payment:array<string>,cdn:array<string>>"
BREAKDOWN = "array<struct<key:string,delta:int>>"

CANDIDATE = "place_id string, name string, address string, plz string, district string, types array<string>, primary_type string, website string, phone string, lat double, lng double"
FETCH = "url string, status int, headers map<string,string>, body string, final_url string, error string, ssl_valid boolean, ssl_expires_at timestamp, http_to_https boolean"
PSI = "url string, performance int, seo int, accessibility int, best_practices int, fetched_at timestamp, error string"
AUDIT = (
    "place_id string, audited_at timestamp, tier string, discovered_url string, discovery_method string, ssl_valid boolean, ssl_expires_at timestamp, http_to_https_redirect boolean, "
    "has_viewport_meta boolean, viewport_meta_content string, psi_mobile_performance int, psi_mobile_seo int, psi_mobile_accessibility int, psi_mobile_best_practices int, psi_fetched_at timestamp, "
    "impressum_url string, impressum_present boolean, impressum_uid string, impressum_company_name string, impressum_address string, impressum_phone string, impressum_email string, impressum_complete boolean, "
    f"tech_stack {TECH_STACK}, generic_emails array<string>, social_links map<string,string>, fetch_error string, fetch_error_at timestamp, intent_tier string, static_signals_expires_at timestamp, "
    "psi_signals_expires_at timestamp, score int, chain_detected boolean, chain_name string, branch_count int, last_modified_signal int, has_structured_data boolean"
)
EXPORT = (
    "place_id string, tier string, sub_tier string, intent_tier string, chain_detected boolean, chain_name string, branch_count int, score int, name string, url string, phone string, email string, "
    "email_is_generic int, address string, plz string, uid string, impressum_complete boolean, psi_mobile_performance int, ssl_valid boolean, cms string, has_structured_data boolean, last_modified_signal int, "
    f"has_social boolean, audited_at timestamp, score_breakdown {BREAKDOWN}"
)
OUTCOME = "id long, lead_id string, status string, channel string, notes string, created_at long"
FILTERED_LOG = "place_id string, chain_name string, url string, matched_pattern string, reason string, filtered_at timestamp"
COLLAPSED_LOG = "apex string, chain_name string, branch_place_id string, branch_url string, branch_score int, collapsed_at timestamp"
DUPLICATE_LOG = "kept_place_id string, dropped_place_id string, normalized_url string, kept_score int, dropped_score int, duplicate_reason string, filtered_at timestamp"


def struct(ddl: str) -> T.StructType:
    return T.StructType.fromDDL(ddl)


def conform(df: DataFrame, ddl: str) -> DataFrame:
    """The schema's columns, in its order and types; missing ones are null."""
    have = set(df.columns)
    return df.select(*[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in struct(ddl)])
