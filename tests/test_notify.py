import datetime as dt

from conftest import rows

from rosterkeep.model import STATE
from rosterkeep.operators import contacts, notify
from rosterkeep.operators.notify import Template

D = dt.date(2026, 1, 1)
TEMPLATES = {
    "delete": Template("S-delete", "{recipient_name}/{recipient_username} gone"),
    "flag": Template("S-flag", "{recipient_name}/{recipient_username} flagged"),
    "quota": Template("S-quota", "{recipient_name}/{recipient_username} {total_feature_storage_mb} of {USER_STORAGE_QUOTA_MB}"),
}


def state_of(spark):
    data = [
        ("a", "Ann", " a@d ", 2), ("b", None, "b@d", 1), ("c", "Cy", "  ", 2), ("d", "Dan", None, 1), ("e", "Eve", "e@d", 0), ("f", "{recipient_username}", "f@d", 1),
    ]
    return spark.createDataFrame([(u, n, e, None, s, None, None, False, D) for u, n, e, s in data], STATE.schema)


def history_of(spark):
    data = [("a", "m2@d", 3), ("a", " m1@d", 1), ("a", "m2@d", 2), ("a", "", 0), ("a", None, 0), ("b", "  ", 1), ("x", "m9@d", 1), ("a", "m0@d ", 2)]
    rows_ = [(u, m, D + dt.timedelta(days=k)) for u, m, k in data]
    return spark.createDataFrame(rows_, "username string, manager_email string, updated_date date")


def quota_of(spark):
    return spark.createDataFrame([("q", "q@d", "Quin", 1234.5), ("r", None, "Ray", 0.125)], "username string, email string, name string, total_feature_storage_mb double")


def test_contacts_in_order_of_appearance(spark):
    listed = contacts.ordered_distinct(history_of(spark), "username", "manager_email", ["updated_date"], "m")
    assert rows(listed) == [("a", ["m1@d", "m0@d", "m2@d"]), ("x", ["m9@d"])]


def test_recipients_without_history_have_an_empty_list(spark):
    got = dict(rows(notify.recipients(state_of(spark), history_of(spark)), "username", "manager_emails"))
    assert got["a"] == ["m1@d", "m0@d", "m2@d"] and got["b"] == [] and got["e"] == []


def queue_of(spark):
    return notify.notification_queue(state_of(spark), history_of(spark), quota_of(spark), TEMPLATES, 100)


def test_queue(spark):
    assert rows(queue_of(spark)) == sorted(
        [
            ("delete", "a", "a@d", ["m1@d", "m0@d", "m2@d"], 3, "S-delete", "Ann/a gone", None),
            ("delete", "c", None, [], 0, "S-delete", "Cy/c gone", "no recipient address"),
            ("flag", "b", "b@d", [], 0, "S-flag", "/b flagged", None),
            ("flag", "d", None, [], 0, "S-flag", "Dan/d flagged", "no recipient address"),
            ("flag", "f", "f@d", [], 0, "S-flag", "{recipient_username}/f flagged", None),
            ("quota", "q", "q@d", [], 0, "S-quota", "Quin/q 1234.50 of 100.00", None),
            ("quota", "r", None, [], 0, "S-quota", "Ray/r 0.13 of 100.00", "no recipient address"),
        ],
        key=lambda t: tuple((v is not None, str(v)) for v in t),
    )


def test_preview_and_counts(spark):
    queue = queue_of(spark)
    lines = [r[0] for r in notify.preview(queue).select("line").collect()]
    assert "DELETE -> a at a@d (cc_count=3)" in lines and "Skipping r: no recipient address" in lines
    assert dict(rows(notify.preview(queue), "username", "cc_text"))["a"] == "m1@d, m0@d, m2@d"
    assert rows(notify.queue_counts(queue)) == [("delete", 2, 1, 3), ("flag", 3, 1, 0), ("quota", 2, 1, 0)]
