"""Record-quality analytics and text-corpus preparation on PySpark."""
