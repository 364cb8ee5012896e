"""Cell-by-gene count tables to training-ready datasets, as Spark DataFrame operators.

The data model is three plain tables:

* ``cells(cell_id, ord, ...)``   one row per cell, ``ord`` is the row position
* ``genes(gene_id, pos, ...)``   one row per gene, ``pos`` is the column position
* ``counts(cell_id, gene_id, value)``  non-zero entries only

Row order never carries meaning; ``ord`` and ``pos`` do.
"""

from atlasloom.model import Atlas

__all__ = ["Atlas"]
