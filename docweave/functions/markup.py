"""The page markup the parsers select.

These names must equal those of the documentation pages being read, so they
are stated here once, in the order a page presents them, and the operators
refer to them by name.
"""

# Fixed values — generic entity pages
TITLE_TAG = "h1"
SUBTITLE_TAG = "h2"
CRUMBS_CLASS = "crumbs"
REFERENCES_ID = "references"
SYNTAX_ID = "syntax"
SYNTAX_BLOCK_CLASS = "simplecode_api"
DESCRIPTION_ID = "description"
VARIABLES_ID = "variables"
MEMBERS_CLASS = "members"
VALUES_ID = "values"
ROW_CLASS = "normal-row"
ARGUMENTS_CLASS = "name-cell-arguments"

# Fixed values — class-detail pages
SUMMARY_CLASS = "summary"
BREADCRUMB_CLASS = "breadcrumb"
INHERITANCE_ID = "hierarchy"
INHERITANCE_ITEM_CLASS = "hierarchyitem"
REMARKS_ID = "remarks"
TYPE_ID = "type"
CONSTRUCTORS_ID = "constructors"
FUNCTIONS_ID = "functions"
CONSTANTS_ID = "constants"
SEE_ALSO_ID = "seealso"
SPECIFIER_MARK = "UProperty"

# Fixed values — index pages
INDEX_COLUMN_ID = "maincol"
INDEX_ITEM_CLASS = "memberindexitem"
INDEX_LINK_ID = "content_link"

# Fixed values — class-hierarchy page
HIERARCHY_TABLE_CLASS = "hierarchy-table"
HIERARCHY_TABLE_ID = "hrch"
HIERARCHY_LABEL_CLASS = "hierarchy-label-cell"
