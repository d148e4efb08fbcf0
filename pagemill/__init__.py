"""pagemill: scanned-document processing analytics as Spark plans."""
