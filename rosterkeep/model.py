"""Report kinds, their columns and types, and the tables derived from them.

Inside the engine columns have snake_case names; the report headers are kept only to read and write files.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, functions as F, types as T

# --- Fixed values: report headers, engine names and declared types, in report order -------------------------------

ITEM_COLUMNS = """
Title                            | title                | string
Item ID                          | item_id              | string
Item Url                         | item_url             | string
Item Type                        | item_type            | string
Date Created                     | date_created         | timestamp
Date Modified                    | date_modified        | timestamp
Content Category                 | content_category     | string
View Counts                      | view_counts          | number
Owner                            | owner                | string
File Storage Size                | file_storage_size    | number
Feature Storage Size             | feature_storage_size | number
Share Level                      | share_level          | string
# of Groups shared with          | groups_shared_with   | number
Tags                             | tags                 | string
Number of Comments               | number_of_comments   | number
Is Hosted Service                | is_hosted_service    | flag
Date Last Viewed                 | date_last_viewed     | timestamp
In Recycle Bin                   | in_recycle_bin       | string
updated_date                     | updated_date         | date
"""

MEMBER_COLUMNS = """
Username                         | username              | string
Name                             | name                  | string
Email                            | email                 | string
Profile Visibility               | profile_visibility    | string
My Esri Access                   | my_esri_access        | string
User Type                        | user_type             | string
Role                             | role                  | string
Available Credits                | available_credits     | number
Assigned Credits                 | assigned_credits      | number
Last Login Date                  | last_login_date       | timestamp
Date Created                     | date_created          | timestamp
Add-On Apps                      | add_on_apps           | string
# of Items Owned                 | items_owned           | number
# of Groups Owned                | groups_owned          | number
# of Groups Total                | groups_total          | number
Login Type                       | login_type            | string
Member Account Status            | member_account_status | string
Verified Email Status            | verified_email_status | flag
Multifactor Authentication Exempt | mfa_exempt           | string
Member Categories                | member_categories     | string
Multifactor Authentication       | mfa                   | string
updated_date                     | updated_date          | date
"""

IDENTITY_COLUMNS = """
Username                         | username           | string
Email                            | email              | string
Name                             | name               | string
EmailsTried                      | emails_tried       | string
EntraID_Status                   | entra_status       | flag
ManagerEmail                     | manager_email      | string
ManagerDepartment                | manager_department | string
UserDepartment                   | user_department    | string
WorkingEmail                     | working_email      | string
Groups                           | groups             | string
updated_date                     | updated_date       | date
"""

MEMBERSHIP_COLUMNS = """
UserID                           | user_id      | string
GroupID                          | group_id     | string
Position                         | pos          | int
updated_date                     | updated_date | date
"""

STATE_COLUMNS = """
Username                         | username      | string
Name                             | name          | string
WorkingEmail                     | working_email | string
ManagerEmail                     | manager_email | string
DeleteStatus                     | delete_status | int
FlagDate                         | flag_date     | date
DeleteDate                       | delete_date   | date
Override                         | override      | flag
updated_date                     | updated_date  | date
"""

OVER_QUOTA_COLUMNS = """
Username                         | username                 | string
Email                            | email                    | string
Name                             | name                     | string
total_feature_storage_mb         | total_feature_storage_mb | number
"""

DELETE_LIST_COLUMNS = """
Username                         | username | string
"""

#: Text in a report title that tells its kind.
TITLE_MARKS = {
    "items": "OrganizationItems",
    "members": "OrganizationMembers",
    "identity": "EntraID_Status",
}

#: Columns that do not belong to a row's state in the history.
NOT_STATE = {
    "items": ("title", "updated_date"),
    "members": ("updated_date",),
    "identity": ("updated_date",),
    "memberships": ("updated_date",),
}

#: Names of the written reports; the run date follows.
DELETE_LIST_NAME = "UsersToDelete"
OVER_QUOTA_NAME = "UsersOverQuota"
ERROR_LIST_NAME = "error_EntraID_users"

# --- End of fixed values ------------------------------------------------------------------------------------------

SPARK_TYPES: dict[str, T.DataType] = {
    "string": T.StringType(),
    "number": T.DoubleType(),
    "timestamp": T.TimestampNTZType(),
    "flag": T.BooleanType(),
    "date": T.DateType(),
    "int": T.IntegerType(),
}


class UnknownKind(ValueError):
    """A report title that fits no known kind."""


@dataclass(frozen=True)
class Field:
    header: str
    name: str
    role: str

    @property
    def spark_type(self) -> T.DataType:
        return SPARK_TYPES[self.role]


def _parse(block: str) -> tuple[Field, ...]:
    rows = (line.split("|") for line in block.strip().splitlines())
    return tuple(Field(*(cell.strip() for cell in row)) for row in rows)


@dataclass(frozen=True)
class Layout:
    """The columns of one report or table."""

    name: str
    fields: tuple[Field, ...]
    not_state: tuple[str, ...] = ()

    @cached_property
    def columns(self) -> list[str]:
        return [f.name for f in self.fields]

    @cached_property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(f.name, f.spark_type) for f in self.fields])

    @cached_property
    def to_header(self) -> dict[str, str]:
        return {f.name: f.header for f in self.fields}

    @cached_property
    def from_header(self) -> dict[str, str]:
        return {f.header: f.name for f in self.fields}

    @cached_property
    def state_key(self) -> list[str]:
        return [name for name in self.columns if name not in self.not_state]


ITEMS = Layout("items", _parse(ITEM_COLUMNS), NOT_STATE["items"])
MEMBERS = Layout("members", _parse(MEMBER_COLUMNS), NOT_STATE["members"])
IDENTITY = Layout("identity", _parse(IDENTITY_COLUMNS), NOT_STATE["identity"])
MEMBERSHIPS = Layout("memberships", _parse(MEMBERSHIP_COLUMNS), NOT_STATE["memberships"])
STATE = Layout("state", _parse(STATE_COLUMNS))
OVER_QUOTA = Layout("over_quota", _parse(OVER_QUOTA_COLUMNS))
DELETE_LIST = Layout("delete_list", _parse(DELETE_LIST_COLUMNS))

KINDS: dict[str, Layout] = {layout.name: layout for layout in (ITEMS, MEMBERS, IDENTITY, MEMBERSHIPS)}


def kind_of(title: str) -> Layout:
    """The kind whose mark occurs in a report title; an unknown title is an error."""
    for kind, mark in TITLE_MARKS.items():
        if mark in title:
            return KINDS[kind]
    raise UnknownKind(f"no report kind for title {title!r}")


def kind_column(title: Column) -> Column:
    """The same test as a column: kind name, or NULL for an unknown title."""
    return F.coalesce(*[F.when(F.contains(title, F.lit(mark)), F.lit(kind)) for kind, mark in TITLE_MARKS.items()])
