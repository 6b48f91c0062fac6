"""Every operator bound to the test tables, with the SQL that must agree with it."""

from catalog import lists, records, roundtrips, search, stored, terms

QUERIES = {**terms.QUERIES, **records.QUERIES, **lists.QUERIES, **search.QUERIES}
QUERIES.update({**roundtrips.QUERIES, **stored.QUERIES})
ORACLE = {**terms.ORACLE, **records.ORACLE, **lists.ORACLE, **search.ORACLE}
ORACLE.update({**roundtrips.ORACLE, **stored.ORACLE})
