"""DataFrame operators."""

from .audit import audit_deleted, audit_invalid_cms, with_run_counters
from .classify import (
    ERROR_STATUS,
    attempt_code,
    clean_domain_info,
    classify_pages,
    error_status,
    page_status,
    resolve_status,
    split_valid,
)
from .export import CRM_FIELDS, contact_updates, crm_code, crm_params, crm_rename, deal_fields, deal_updates
from .features import extract_features
from .filters import first_n, id_bounds, portion, retry_set, search_domains, with_domain
from .lookups import (
    category_tags,
    contact_finds,
    deal_properties,
    delete_where,
    inn_regions,
    merge_contact_pages,
    phone_locations,
    region_names,
    shop_flags,
)
from .quality import fk_orphans, length_violations, null_violations, unique_violations
from .regions import REGIONS, default_regions
from .registry import parse_registry, read_documents, registry_tables, turnover_segment
from .rules import Rule, default_rules
from .sizing import broadcast_if_small, clear_staged, fits_broadcast, shared_dir, staged
from .stats import cms_counts, column_counts, count_status, real_domain_copies, real_domain_counts, status_counts
from .tagging import category_votes, identify_category
from .upsert import (
    assign_ids,
    dedupe_real_domain,
    explode_contacts,
    first_per_key,
    insert_ignore,
    last_per_key,
    upsert,
    upsert_domain_info,
    upsert_inns,
)

__all__ = [name for name in dir() if not name.startswith("_")]
