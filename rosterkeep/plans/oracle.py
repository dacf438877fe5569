"""The queries of ``queries.py`` written independently as SQL over the test tables."""

from __future__ import annotations

# --- Tables the queries share -------------------------------------------------------------------------------------

_MEMBERS = """
members AS (
  SELECT c_custkey::VARCHAR AS username, 'c' || c_custkey || '@corp.example' AS email, c_name AS name FROM customer
)"""

_QUOTA = f"""
WITH {_MEMBERS},
report AS (
  SELECT m.username, m.email, m.name, sum(o.o_totalprice::DECIMAL(28,6))::DOUBLE AS total_feature_storage_mb
  FROM members m JOIN orders o ON m.username = o.o_custkey::VARCHAR
  GROUP BY m.username, m.email, m.name
  HAVING sum(o.o_totalprice::DECIMAL(28,6)) > 3700000
)"""

_STATE = """
state AS (
  SELECT c_custkey::VARCHAR AS username, c_name AS name,
         CASE WHEN c_custkey % 10 <> 0 THEN ' c' || c_custkey || '@corp.example' END AS working_email,
         (c_custkey % 3)::INTEGER AS delete_status,
         CASE WHEN c_custkey % 3 = 1 THEN last_order END AS flag_date,
         NULL::DATE AS delete_date, c_custkey % 17 = 0 AS override
  FROM customer LEFT JOIN (SELECT o_custkey, max(o_orderdate)::DATE AS last_order FROM orders GROUP BY o_custkey)
    ON c_custkey = o_custkey
)"""

_FACTS = """
facts AS (
  SELECT c_custkey::VARCHAR AS username,
         CASE c_nationkey % 3 WHEN 0 THEN FALSE WHEN 1 THEN TRUE END AS entra_status,
         c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT') AS empty,
         c_nationkey % 3 = 1 AND c_mktsegment IN ('BUILDING', 'MACHINERY') AS whitelisted, unnamed
  FROM (SELECT *, c_nationkey % 3 = 2 AND c_custkey % 2 = 0 AS unnamed FROM customer)
)"""

_MOVED = f"""
WITH {_STATE}, {_FACTS},
ruled AS (
  SELECT s.*, CASE
      WHEN override THEN 'R1'
      WHEN empty THEN 'R2'
      WHEN delete_status = 0 AND entra_status IS NULL THEN 'R6'
      WHEN delete_status = 0 AND NOT entra_status THEN 'R3'
      WHEN delete_status = 0 AND whitelisted THEN 'R4'
      WHEN delete_status = 0 THEN 'R5'
      WHEN delete_status = 1 AND datediff('day', flag_date, DATE '2001-08-01') >= 30 THEN 'R7'
      ELSE 'R8' END AS rule
  FROM state s JOIN facts f ON s.username = f.username
),
moved AS (
  SELECT username, name, working_email, override, rule, delete_status AS old_status,
         CASE WHEN rule IN ('R1', 'R4') THEN 0 WHEN rule IN ('R3', 'R5') THEN 1 WHEN rule IN ('R2', 'R7') THEN 2
              ELSE delete_status END AS delete_status,
         CASE WHEN rule IN ('R1', 'R4') THEN NULL WHEN rule IN ('R2', 'R3', 'R5') THEN DATE '2001-08-01'
              ELSE flag_date END AS flag_date,
         CASE WHEN rule IN ('R1', 'R4') THEN NULL WHEN rule = 'R7' THEN DATE '2001-08-01'
              ELSE delete_date END AS delete_date
  FROM ruled
)"""

_IDENTITY_ROWS = """
identity_rows AS (
  SELECT o_custkey::VARCHAR AS username,
         CASE WHEN o_orderpriority <> '5-LOW' THEN ' ' || o_orderpriority || '@corp.example' END AS manager_email,
         o_orderstatus = 'F' AS entra_status, o_orderdate::DATE AS updated_date
  FROM orders
)"""

_IDENTITY_HISTORY = f"""
WITH {_IDENTITY_ROWS}
SELECT username, manager_email, entra_status, max(updated_date)::VARCHAR AS updated_date
FROM identity_rows GROUP BY username, manager_email, entra_status"""

_CONTACTS = f"""
{_IDENTITY_ROWS},
contact AS (
  SELECT username, trim(manager_email) AS address, min(updated_date) AS seen
  FROM identity_rows WHERE manager_email IS NOT NULL GROUP BY ALL
),
contacts AS (
  SELECT username, string_agg(address, '|' ORDER BY seen, address) AS cc, count(*) AS n FROM contact GROUP BY username
)"""

_QUEUE = f"""
{_MOVED}, {_CONTACTS}, {_QUOTA.replace("WITH", "", 1)},
queue AS (
  SELECT CASE m.delete_status WHEN 2 THEN 'delete' ELSE 'flag' END AS kind, m.username, trim(m.working_email) AS recipient,
         coalesce(c.cc, '') AS cc, coalesce(c.n, 0)::INTEGER AS cc_count,
         CASE m.delete_status WHEN 2 THEN 'Your account has been deleted'
              ELSE 'Action needed: your account has been flagged for deletion' END AS subject,
         'Dear ' || m.name || ',' || chr(10) || chr(10) || 'your account ' || m.username ||
         CASE m.delete_status WHEN 2 THEN ' will be deleted.' ELSE ' is flagged and will be deleted in a month.' END ||
         chr(10) AS body,
         CASE WHEN m.working_email IS NULL THEN 'no recipient address' END AS skip_reason
  FROM moved m LEFT JOIN contacts c ON m.username = c.username WHERE m.delete_status IN (1, 2)
  UNION ALL
  SELECT 'quota', username, email, '', 0, 'Action needed: storage quota exceeded',
         'Dear ' || name || ',' || chr(10) || chr(10) || 'your account ' || username || ' uses ' ||
         total_feature_storage_mb::DECIMAL(28,2)::VARCHAR || ' MB; the quota is 3700000.00 MB.' || chr(10), NULL
  FROM report
)"""

_DIRECTORY = """
directory AS (
  SELECT c_custkey AS pos, c_custkey::VARCHAR AS id,
         CASE WHEN c_custkey % 4 = 0 THEN 'Ext' || c_custkey || '@partner.example'
              ELSE lower(c_name) || '@corp.example' END AS upn,
         'm' || (c_custkey % 700) || '@corp.example' AS mail,
         CASE WHEN c_custkey % 4 = 0 THEN upper(lower(c_name) || '@corp.example') END AS other,
         c_mktsegment AS department
  FROM customer
),
addresses AS (
  SELECT lower(upn) AS key, pos, id, department FROM directory
  UNION ALL SELECT lower(mail), pos, id, department FROM directory
),
principals AS (
  SELECT key, id AS user_id, department FROM addresses QUALIFY row_number() OVER (PARTITION BY key ORDER BY pos) = 1
),
others AS (
  SELECT key, upn AS principal_name
  FROM (SELECT lower(other) AS key, pos, upn FROM directory WHERE other IS NOT NULL
        UNION ALL SELECT 'shared@corp.example', pos, upn FROM directory WHERE other IS NOT NULL)
  QUALIFY row_number() OVER (PARTITION BY key ORDER BY pos) = 1
),
alternates AS (
  SELECT o.key, o.principal_name AS address, p.user_id, p.department
  FROM others o LEFT JOIN principals p ON lower(o.principal_name) = p.key
)"""

_ACCOUNTS = """
accounts AS (
  SELECT c_name AS name, c_name || '_ORG' AS username,
         CASE WHEN c_custkey % 5 <> 0 THEN 'M' || c_custkey || '@corp.example' END AS email FROM customer
  UNION ALL
  SELECT s_name, s_name || '_ORG', CASE WHEN s_suppkey % 5 <> 0 THEN 'S' || s_suppkey || '@corp.example' END FROM supplier
),
tries AS (
  SELECT username, 1 AS pos, email AS tried FROM accounts WHERE email IS NOT NULL
  UNION ALL SELECT username, 2, name || '@corp.example' FROM accounts
  UNION ALL SELECT username, 3, '@corp.example' FROM accounts WHERE email IS NULL
)"""

_RESOLVED = f"""
WITH {_DIRECTORY}, {_ACCOUNTS},
direct AS (
  SELECT username, tried AS address, user_id, department FROM tries JOIN principals ON lower(tried) = key
  QUALIFY row_number() OVER (PARTITION BY username ORDER BY pos) = 1
),
led AS (
  SELECT username, address, user_id, department FROM tries JOIN alternates ON lower(tried) = key
  QUALIFY row_number() OVER (PARTITION BY username ORDER BY pos) = 1
),
resolved AS (
  SELECT a.username, a.email, a.name, coalesce(d.address, l.address) AS address,
         CASE WHEN d.username IS NOT NULL THEN d.user_id ELSE l.user_id END AS user_id,
         CASE WHEN d.username IS NOT NULL THEN d.department ELSE l.department END AS department, l.address AS alternate
  FROM accounts a LEFT JOIN direct d ON a.username = d.username LEFT JOIN led l ON a.username = l.username
)"""

_STATUS = f"""
{_RESOLVED},
tried AS (SELECT username, string_agg(tried, ', ' ORDER BY pos) AS tried FROM tries GROUP BY username),
many AS (
  SELECT o_custkey::VARCHAR AS user_id, o_orderkey::VARCHAR AS group_id, datediff('day', DATE '1990-01-01', o_orderdate::DATE) AS pos FROM orders
  UNION ALL SELECT l_suppkey::VARCHAR, l_orderkey || '-' || l_linenumber, l_orderkey * 10 + l_linenumber + 100000 FROM lineitem
),
memberships AS (SELECT user_id, string_agg(group_id, ', ' ORDER BY pos, group_id) AS groups FROM many GROUP BY user_id),
status AS (
  SELECT r.username, r.email, r.name,
         t.tried || coalesce(', ' || r.alternate, '') AS emails_tried,
         r.address IS NOT NULL AS entra_status, boss.mail AS manager_email, boss.department AS manager_department,
         r.department AS user_department, r.address AS working_email, g.groups,
         '2001-08-01' AS updated_date, r.user_id AS directory_id
  FROM resolved r JOIN tried t ON r.username = t.username
  LEFT JOIN directory boss ON boss.pos = r.user_id::BIGINT + 750
  LEFT JOIN memberships g ON g.user_id = r.user_id
)"""

_ITEMS_HISTORY = """
SELECT max(l_linenumber::VARCHAR) AS title, item_id, item_type, owner, share_level, feature_storage_size, is_hosted_service,
       d::VARCHAR AS updated_date
FROM (
  SELECT l_linenumber, l_partkey::VARCHAR AS item_id, l_returnflag AS item_type, l_suppkey::VARCHAR AS owner,
         l_linestatus AS share_level, l_quantity AS feature_storage_size,
         CASE WHEN l_tax > 0 THEN l_tax > 0.04::DOUBLE END AS is_hosted_service, l_shipdate::DATE AS d,
         max(l_shipdate::DATE) OVER (PARTITION BY l_partkey, l_returnflag, l_suppkey, l_linestatus, l_quantity,
                                     CASE WHEN l_tax > 0 THEN l_tax > 0.04::DOUBLE END) AS newest
  FROM lineitem
) WHERE d = newest
GROUP BY item_id, item_type, owner, share_level, feature_storage_size, is_hosted_service, d"""

# --- One statement per query --------------------------------------------------------------------------------------

ORACLE: dict[str, str] = {
    "over_quota_report": f"{_QUOTA} SELECT * FROM report",
    "storage_by_owner": """
        SELECT o_custkey::VARCHAR AS owner, sum(o_totalprice::DECIMAL(28,6))::DOUBLE AS total_mb FROM orders GROUP BY o_custkey""",
    "over_quota_beyond_decimals": f"""
        WITH {_MEMBERS},
        sized AS (
          SELECT o_custkey::VARCHAR AS owner, CASE WHEN o_orderkey % 1000 IN (1, 2) OR o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice::DECIMAL(28,6) END AS size,
                 CASE o_orderkey % 1000 WHEN 1 THEN 'inf'::DOUBLE WHEN 2 THEN 1e23::DOUBLE END AS beyond FROM orders),
        totals AS (SELECT owner, sum(size) AS total, sum(beyond) AS beyond FROM sized GROUP BY owner)
        SELECT username, email, name,
               CASE WHEN beyond IS NULL THEN total::DOUBLE ELSE coalesce(total::DOUBLE, 0) + beyond END AS total_feature_storage_mb
        FROM members JOIN totals ON username = owner WHERE CASE WHEN beyond IS NULL THEN total > 3700000 ELSE true END""",
    "latest_snapshot": """
        SELECT event_type, event_id, user_id, value FROM events
        QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) = 1""",
    "newest_snapshot_rows": """
        SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders)""",
    "newest_dated_report": """
        SELECT o_orderkey, 'UsersOverQuota_' || strftime(o_orderdate, '%Y_%m_%d') AS report
        FROM orders WHERE o_orderdate::DATE = (SELECT max(o_orderdate)::DATE FROM orders)""",
    "pending_snapshots": """
        SELECT DISTINCT l_shipdate::DATE::VARCHAR AS snapshot_date FROM lineitem
        WHERE l_shipdate::DATE NOT IN (SELECT o_orderdate::DATE FROM orders)""",
    "report_names": """
        SELECT o_orderkey,
               CASE o_orderstatus WHEN 'F' THEN 'OrganizationItems_' WHEN 'O' THEN 'OrganizationMembers_' ELSE 'Other_' END
               || strftime(o_orderdate, '%Y_%m_%d') || '_' || replace(replace(o_orderpriority, '-', '_'), '/', '_') AS table_name,
               CASE o_orderstatus WHEN 'F' THEN 'items' WHEN 'O' THEN 'members' END AS kind
        FROM orders""",
    "snapshot_stamp": "SELECT s_suppkey, s_name, '2001-08-01' AS updated_date FROM supplier",
    "csv_round_trip": "SELECT doc_id, text, lang, source, n_chars FROM documents",
    "report_intake": """
        SELECT o_custkey::VARCHAR AS username, CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END AS role,
               o_orderstatus AS login_type, NULL::DOUBLE AS available_credits, '2001-08-01' AS updated_date FROM orders""",
    "projected_scan": f"WITH {_IDENTITY_ROWS} SELECT username, manager_email, NULL::VARCHAR AS groups FROM identity_rows",
    "versioned_table": f"""
        WITH {_STATE} SELECT username, delete_status, override OR (delete_status = 2 AND working_email IS NOT NULL) AS override FROM state""",
    "lenient_typing": """
        SELECT event_id, CASE WHEN event_type NOT IN ('error', 'view') THEN value END AS number FROM events""",
    "lenient_timestamps": """
        SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
               WHEN 'O' THEN strftime(o_orderdate, '%Y-%m-%d 00:00:00') END AS read_as FROM orders""",
    "lenient_flags": """
        SELECT l_returnflag, l_linestatus, CASE l_returnflag WHEN 'A' THEN TRUE WHEN 'N' THEN FALSE END AS flag, count(*) AS n
        FROM lineitem GROUP BY ALL""",
    "unreadable_values": """
        SELECT event_id, CASE event_type WHEN 'error' THEN 'value: n/a' ELSE 'seen: yesterday' END AS unreadable
        FROM events WHERE event_type IN ('error', 'click')""",
    "blank_test": r"""
        SELECT conv_id, turn, role <> 'user' OR regexp_full_match(text, '\s*') AS blank,
               CASE WHEN role = 'user' AND NOT regexp_full_match(text, '\s*')
                    THEN regexp_replace(text, '^\s+|\s+$', '', 'g') END AS stripped
        FROM conversations""",
    "long_values": """
        SELECT doc_id, ((length(text) > 255)::INTEGER + (length(lang) > 255)::INTEGER + (length(source) > 255)::INTEGER) AS too_long
        FROM documents""",
    "history_latest_state": """
        SELECT user_id, event_type, event_id, value, props, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) = 1""",
    "history_latest_text": "SELECT lang, text, max(doc_id) AS doc_id FROM documents GROUP BY lang, text",
    "history_caseless": """
        SELECT user, role, o_orderkey FROM (
          SELECT o_custkey::VARCHAR AS user, o_orderkey, o_orderpriority,
                 CASE o_orderstatus WHEN 'F' THEN lower(o_orderpriority) || '  ' ELSE o_orderpriority END AS role FROM orders)
        QUALIFY row_number() OVER (PARTITION BY user, o_orderpriority ORDER BY o_orderkey DESC) = 1""",
    "history_append_by_name": """
        SELECT c_custkey::VARCHAR AS key, c_name AS name, c_acctbal AS balance, c_mktsegment AS segment FROM customer
        UNION ALL SELECT s_suppkey::VARCHAR, s_name, s_acctbal, NULL FROM supplier""",
    "history_items": _ITEMS_HISTORY,
    "history_members": """
        SELECT o_custkey::VARCHAR AS username, CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderpriority END AS role,
               o_orderstatus AS login_type, max(o_orderdate::DATE)::VARCHAR AS updated_date
        FROM orders GROUP BY ALL""",
    "history_bootstrap": _IDENTITY_HISTORY,
    "history_incremental": _IDENTITY_HISTORY,
    "history_compacted": _IDENTITY_HISTORY,
    "history_tiers": _IDENTITY_HISTORY,
    "history_expired": f"""
        WITH {_IDENTITY_ROWS},
        dated AS (SELECT *, least(greatest(coalesce(year(updated_date), 0), 1995), 2001) AS y FROM identity_rows),
        snapshot AS (SELECT d.*, s.year FROM dated d, (SELECT unnest(range(1995, 2002)) AS year) s WHERE y = s.year OR (y < s.year AND username::INTEGER % 8 = s.year % 8)),
        seen AS (SELECT username, count(DISTINCT year) AS n FROM snapshot GROUP BY username)
        SELECT 'history' AS part, username, concat_ws(' ', manager_email, entra_status, max(updated_date)::VARCHAR) AS value
        FROM identity_rows GROUP BY username, manager_email, entra_status
        UNION ALL SELECT 'snapshot', username, count(*)::VARCHAR FROM snapshot WHERE year = 2001 GROUP BY username
        UNION ALL SELECT 'state', c_custkey::VARCHAR, coalesce(n, 0)::VARCHAR FROM customer LEFT JOIN seen ON username = c_custkey::VARCHAR""",
    "streaming_intake": _IDENTITY_HISTORY,
    "streaming_rewritten": _IDENTITY_HISTORY,
    "report_parts": """
        SELECT o_custkey::VARCHAR AS username, CASE WHEN o_orderstatus <> 'F' AND o_orderpriority <> '5-LOW' THEN o_orderpriority END AS role,
               o_orderstatus AS login_type FROM orders""",
    "malformed_report_rows": """
        WITH made AS (
            SELECT o_orderkey::VARCHAR AS key, o_orderpriority || ',' || chr(10) || chr(34) || o_orderstatus || chr(34) AS note,
                   o_custkey % 11 <> 0 AS owned, o_custkey % 7 = 0 AS more, o_custkey::VARCHAR AS cust
            FROM orders
        )
        SELECT key AS username, note AS name, CASE WHEN owned THEN cust ELSE 'more' END AS email, '' AS reason FROM made WHERE owned <> more
        UNION ALL
        SELECT key, concat_ws(',', key, chr(34) || replace(note, chr(34), chr(34) || chr(34)) || chr(34), CASE WHEN owned THEN cust END, CASE WHEN more THEN 'more' END),
               '', 'number of fields'
        FROM made WHERE owned = more""",
    "written_reports": f"{_QUOTA} SELECT * FROM report",
    "directory_exports": f"""
        WITH {_DIRECTORY} SELECT key, user_id, p.department, boss.mail AS manager_email
        FROM principals p LEFT JOIN directory boss ON boss.pos = user_id::BIGINT + 750""",
    "whitelist_export": """
        SELECT c_custkey::VARCHAR AS username, c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT') AS whitelisted FROM customer""",
    "template_files": f"""
        {_QUEUE} SELECT username, subject, '[quota]' || chr(10) || body AS body FROM queue WHERE kind = 'quota'""",
    "users_without_items": """
        SELECT DISTINCT c_custkey::VARCHAR AS username FROM customer LEFT JOIN events ON c_custkey = user_id
        WHERE event_id IS NULL OR (event_type = 'error' AND value > 200)""",
    "users_without_items_caseless": """
        SELECT upper(s_name) AS username FROM supplier
        WHERE s_suppkey NOT IN (SELECT l_suppkey FROM lineitem WHERE l_quantity >= 50 AND l_discount = 0)""",
    "new_users": f"""
        WITH {_MEMBERS} SELECT username, name, email AS working_email, NULL::VARCHAR AS manager_email, 0 AS delete_status,
               NULL::VARCHAR AS flag_date, NULL::VARCHAR AS delete_date, FALSE AS override, '2001-08-01' AS updated_date
        FROM members WHERE username NOT IN (SELECT s_suppkey::VARCHAR FROM supplier)""",
    "new_users_upsert": f"""
        WITH {_MEMBERS} SELECT username, name, email AS working_email, NULL::VARCHAR AS manager_email, 0 AS delete_status,
               NULL::VARCHAR AS flag_date, NULL::VARCHAR AS delete_date, FALSE AS override, '2001-08-01' AS updated_date
        FROM members WHERE username NOT IN (SELECT s_suppkey::VARCHAR FROM supplier)
        UNION ALL SELECT s_suppkey::VARCHAR, s_name, NULL, NULL, s_nationkey % 3, NULL, NULL, s_acctbal < 0, '2001-08-01' FROM supplier""",
    "listed_marker": """
        SELECT c_custkey::VARCHAR AS username, c_custkey IN (SELECT user_id FROM events) AS listed FROM customer""",
    "whitelist_match": """
        SELECT p_partkey::VARCHAR AS username, list_has_any(string_split(p_name, ' '), ['red', 'ring']) AS whitelisted FROM part""",
    "whitelist_match_edges": """
        SELECT c_custkey::VARCHAR AS username, r_name = 'ASIA' AS whitelisted
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "account_facts": f"WITH {_FACTS} SELECT username, entra_status, empty, coalesce(whitelisted, FALSE) AS whitelisted FROM facts WHERE NOT unnamed OR empty",
    "lifecycle_transition": f"""
        {_MOVED} SELECT username, old_status, rule, delete_status, flag_date::VARCHAR AS flag_date,
               delete_date::VARCHAR AS delete_date, override FROM moved""",
    "lifecycle_counts": f"{_MOVED} SELECT rule, delete_status AS new_status, count(*) AS accounts FROM moved GROUP BY ALL",
    "legacy_counters": f"""
        {_MOVED} SELECT count(*) FILTER (rule IN ('R1', 'R3', 'R4')) AS unflagged,
               count(*) FILTER (rule IN ('R2', 'R5') OR (rule = 'R8' AND old_status = 1)) AS flagged,
               count(*) FILTER (rule = 'R7' OR (rule = 'R8' AND old_status = 2)) AS deleted FROM moved""",
    "delete_list": f"{_MOVED} SELECT DISTINCT username FROM moved WHERE delete_status = 2",
    "delete_counts": f"{_MOVED} SELECT count(*) AS accounts FROM moved WHERE delete_status = 2",
    "flagged_accounts": f"WITH {_STATE} SELECT username, flag_date::VARCHAR AS flag_date FROM state WHERE delete_status = 1",
    "lookup_by_address": f"""
        WITH {_STATE} SELECT username, trim(working_email) AS working_email, override FROM state
        WHERE trim(working_email) = 'c42@corp.example'""",
    "override_update": f"""
        WITH {_STATE} SELECT username, CASE WHEN s_suppkey IS NOT NULL AND working_email IS NOT NULL THEN s_nationkey < 5 ELSE override END AS override
        FROM state LEFT JOIN supplier ON username = s_suppkey::VARCHAR""",
    "candidate_addresses": f"""
        WITH {_ACCOUNTS} SELECT username, string_agg(tried, '|' ORDER BY pos) AS candidates FROM tries GROUP BY username""",
    "principal_index": f"WITH {_DIRECTORY} SELECT * FROM principals",
    "other_mail_index": f"WITH {_DIRECTORY} SELECT * FROM others",
    "alternate_addresses": f"WITH {_DIRECTORY} SELECT key, address, user_id FROM alternates",
    "address_resolution": f"{_RESOLVED} SELECT username, address, user_id, alternate FROM resolved WHERE address IS NOT NULL",
    "manager_lookup": f"""
        WITH {_DIRECTORY} SELECT u.id AS user_id, boss.mail AS manager_email, boss.department AS manager_department
        FROM directory u JOIN directory boss ON boss.pos = u.pos + 750""",
    "group_concat_truncated": """
        SELECT l_orderkey, substr(string_agg(l_partkey::VARCHAR, ', ' ORDER BY l_linenumber, l_partkey), 1, 30) AS parts
        FROM lineitem GROUP BY l_orderkey""",
    "group_concat": """
        SELECT l_orderkey, string_agg(l_partkey::VARCHAR, ', ' ORDER BY l_linenumber, l_partkey) AS parts FROM lineitem GROUP BY l_orderkey""",
    "identity_resolution": f"{_STATUS} SELECT * FROM status",
    "identity_later_listing": f"{_STATUS} SELECT * FROM status",
    "contacts_maintained": f"WITH {_CONTACTS} SELECT username, cc AS manager_emails FROM contacts",
    "identity_resolution_legacy": f"""
        {_STATUS} SELECT * REPLACE (substr(emails_tried, 1, 500) AS emails_tried, substr(groups, 1, 1000) AS groups) FROM status""",
    "history_late_group": f"""
        {_STATUS}, late AS (SELECT user_id, max(pos) AS pos FROM many GROUP BY user_id),
        early AS (SELECT m.user_id, string_agg(group_id, ', ' ORDER BY m.pos, group_id) AS groups
                  FROM many m JOIN late l ON m.user_id = l.user_id AND m.pos < l.pos GROUP BY m.user_id)
        SELECT user_id AS username, groups, '2001-07-01' AS updated_date FROM early
        UNION ALL SELECT user_id, groups, '2001-08-01' FROM memberships""",
    "identity_errors": """
        SELECT c_name AS name FROM customer WHERE c_custkey % 5 = 0
        UNION ALL SELECT s_name FROM supplier WHERE s_suppkey % 5 = 0""",
    "contacts_ordered_distinct": """
        SELECT o_custkey, string_agg(o_orderpriority, '|' ORDER BY seen) AS priorities FROM (
          SELECT o_custkey, o_orderpriority, min((o_orderdate, o_orderkey)) AS seen FROM orders GROUP BY ALL)
        GROUP BY o_custkey""",
    "contacts_of_accounts": f"""
        WITH {_STATE}, {_CONTACTS},
        people AS (SELECT username, name FROM state UNION ALL SELECT s_name, s_name FROM supplier)
        SELECT p.username, p.name, coalesce(c.cc, '') AS manager_emails FROM people p LEFT JOIN contacts c ON p.username = c.username""",
    "notification_queue": f"{_QUEUE} SELECT * FROM queue",
    "quota_notices": f"{_QUEUE} SELECT username, recipient, subject, body FROM queue WHERE kind = 'quota'",
    "notification_preview": f"""
        {_QUEUE} SELECT kind, username, recipient, replace(cc, '|', ', ') AS cc_text, cc_count, skip_reason,
               CASE WHEN skip_reason IS NULL THEN upper(kind) || ' -> ' || username || ' at ' || recipient || ' (cc_count=' || cc_count || ')'
                    ELSE 'Skipping ' || username || ': ' || skip_reason END AS line FROM queue""",
    "notification_counts": f"""
        {_QUEUE} SELECT kind, count(*) AS notices, count(skip_reason) AS skipped, sum(cc_count)::BIGINT AS copies FROM queue GROUP BY kind""",
    "template_fill": """
        SELECT c_custkey, 'Dear ' || CASE c_mktsegment WHEN 'BUILDING' THEN '{balance}' WHEN 'MACHINERY' THEN '' ELSE c_name END || ',' || chr(10)
               || 'balance ' || c_acctbal::DECIMAL(28,2)::VARCHAR || ' of {all}' AS body FROM customer""",
    "whole_run": f"""
        {_STATUS},
        owners AS (SELECT DISTINCT c_name || '_ORG' AS owner FROM customer JOIN orders ON c_custkey = o_custkey),
        urgent AS (SELECT DISTINCT o_custkey::VARCHAR AS user_id FROM orders WHERE o_orderpriority = '1-URGENT'),
        ruled AS (
          SELECT username, working_email, CASE WHEN username NOT IN (SELECT owner FROM owners) THEN 'R2'
                 WHEN NOT entra_status THEN 'R3'
                 WHEN directory_id IN (SELECT user_id FROM urgent) THEN 'R4' ELSE 'R5' END AS rule FROM status)
        SELECT username, working_email, rule, CASE rule WHEN 'R2' THEN 2 WHEN 'R4' THEN 0 ELSE 1 END AS delete_status,
               CASE WHEN rule <> 'R4' THEN '2001-08-01' END AS flag_date FROM ruled""",
    "run_counts": f"""
        {_STATUS},
        owned AS (SELECT c_name || '_ORG' AS owner, o_totalprice AS size FROM orders LEFT JOIN customer ON c_custkey = o_custkey),
        urgent AS (SELECT DISTINCT o_custkey::VARCHAR AS user_id FROM orders WHERE o_orderpriority = '1-URGENT'),
        ruled AS (
          SELECT username NOT IN (SELECT owner FROM owned WHERE owner IS NOT NULL) AS empty, entra_status, emails_tried,
                 CASE WHEN username NOT IN (SELECT owner FROM owned WHERE owner IS NOT NULL) THEN 'R2' WHEN NOT entra_status THEN 'R3'
                      WHEN directory_id IN (SELECT user_id FROM urgent) THEN 'R4' ELSE 'R5' END AS rule
          FROM status),
        over AS (
          SELECT username FROM accounts JOIN owned ON username = owner GROUP BY username, email, name HAVING sum(size::DECIMAL(28,6)) > 3700000),
        n AS (SELECT count(*) AS accounts, count(*) FILTER (WHERE entra_status) AS found, count(*) FILTER (WHERE empty) AS empty,
                     count(*) FILTER (WHERE rule = 'R4') AS s0, count(*) FILTER (WHERE rule IN ('R3', 'R5')) AS s1, count(*) FILTER (WHERE rule = 'R2') AS s2 FROM ruled)
        SELECT 'items' AS step, unnest(['rows', 'malformed', 'unreadable']) AS name, unnest([count(*), 0, 0]) AS value FROM orders
        UNION ALL SELECT 'members', unnest(['rows', 'malformed', 'unreadable']), unnest([accounts, 0, 0]) FROM n
        UNION ALL SELECT 'identity', unnest(['rows', 'found', 'errors', 'resolved']), unnest([accounts, found, 0, accounts]) FROM n
        UNION ALL SELECT 'state', unnest(['accounts', 'new', 'empty', 'status 0', 'status 1', 'status 2']), unnest([accounts, accounts, empty, s0, s1, s2]) FROM n
        UNION ALL SELECT 'state', r.rule, count(ruled.rule) FROM (SELECT unnest(['R1', 'R2', 'R3', 'R4', 'R5', 'R6', 'R7', 'R8']) AS rule) r LEFT JOIN ruled ON ruled.rule = r.rule GROUP BY r.rule
        UNION ALL SELECT 'delete list', 'rows', s2 FROM n
        UNION ALL SELECT 'over quota', 'rows', count(*) FROM over""",
    "second_run": f"""
        {_STATUS},
        owned AS (SELECT c_name || '_ORG' AS owner, o_totalprice AS size, c_custkey % 2 = 0 AS still FROM customer JOIN orders ON c_custkey = o_custkey),
        urgent AS (SELECT DISTINCT o_custkey::VARCHAR AS user_id FROM orders WHERE o_orderpriority = '1-URGENT'),
        first AS (
          SELECT s.*, directory_id IN (SELECT user_id FROM urgent) AS listed,
                 CASE WHEN username NOT IN (SELECT owner FROM owned) THEN 'R2' WHEN NOT entra_status THEN 'R3'
                      WHEN directory_id IN (SELECT user_id FROM urgent) THEN 'R4' ELSE 'R5' END AS rule FROM status s),
        state AS (
          SELECT *, CASE rule WHEN 'R2' THEN 2 WHEN 'R4' THEN 0 ELSE 1 END AS old_status,
                 CASE WHEN rule <> 'R4' THEN DATE '2001-08-01' END AS flagged FROM first),
        asked AS (SELECT DISTINCT trim(working_email) AS address FROM state WHERE old_status = 1 AND username LIKE '%7_ORG'),
        ruled AS (
          SELECT *, CASE WHEN trim(working_email) IN (SELECT address FROM asked WHERE address IS NOT NULL) THEN 'R1'
                         WHEN username NOT IN (SELECT owner FROM owned WHERE still) THEN 'R2'
                         WHEN old_status = 0 AND NOT entra_status THEN 'R3' WHEN old_status = 0 AND listed THEN 'R4'
                         WHEN old_status = 0 THEN 'R5' WHEN old_status = 1 THEN 'R7' ELSE 'R8' END AS second FROM state),
        moved AS (
          SELECT *, CASE WHEN second IN ('R1', 'R4') THEN 0 WHEN second IN ('R3', 'R5') THEN 1 WHEN second IN ('R2', 'R7') THEN 2 ELSE old_status END AS new_status,
                 CASE WHEN second IN ('R1', 'R4') THEN NULL WHEN second IN ('R2', 'R3', 'R5') THEN DATE '2001-09-05' ELSE flagged END AS flag_date FROM ruled),
        over AS (
          SELECT username, email, sum(size::DECIMAL(28,6)) AS total FROM accounts JOIN owned ON username = owner AND still
          GROUP BY username, email HAVING sum(size::DECIMAL(28,6)) > 3700000)
        SELECT 'move' AS part, username, concat_ws(' ', second, old_status, new_status, flag_date::VARCHAR) AS value FROM moved
        UNION ALL SELECT 'delete', username, NULL FROM (SELECT DISTINCT username FROM moved WHERE new_status = 2)
        UNION ALL SELECT 'quota', username, total::DECIMAL(28,2)::VARCHAR FROM over
        UNION ALL SELECT 'notice', username, CASE new_status WHEN 2 THEN 'delete ' ELSE 'flag ' END || coalesce(trim(working_email), 'no recipient address')
          FROM moved WHERE new_status IN (1, 2)
        UNION ALL SELECT 'notice', username, concat_ws(' ', 'quota', coalesce(email, 'no recipient address')) FROM over
        UNION ALL SELECT 'history', owner, count(*)::VARCHAR FROM owned GROUP BY owner""",
}
