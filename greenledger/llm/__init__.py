"""Training-data operators: quality, tokens, dedup, sharding, packing, PII, language.

Nothing else in the library imports this subpackage. Each module holds one
operator with its general interface; ``queries.py`` registers the thin
``opN_<name>`` queries over the ``documents`` table.

Conventions shared by all operators
-----------------------------------
* ``text`` null counts as the empty text unless a docstring says otherwise.
* ``doc_id`` may be null or repeated: rows are told apart by an internal row
  number that is written once to the shared folder, never by ``doc_id``.
  A null ``doc_id`` sorts after every other one.
* Extra input columns are ignored, or carried through unchanged where an
  operator returns documents. Internal columns get names that the input does
  not use.
* An empty table gives an empty result with the same schema.
"""

import sys

from pyspark.cloudpickle import register_pickle_by_value

# Functions sent to executors carry their code along: the library need not be
# installed there.
register_pickle_by_value(sys.modules[__name__])
