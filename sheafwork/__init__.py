"""sheafwork: a Spark-native engine for regulatory company filings.

Sub-packages
------------
functions   column expressions (text cleaning, parsing helpers)
operators   DataFrame operators (segmentation, change capture, history, joins)
sources     readers for indexes, metadata, raw filings and stored pages
plans       end-to-end plans composed of the above
streaming   incremental file streams
"""

__version__ = "0.1.0"
