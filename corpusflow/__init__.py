"""corpusflow: building and auditing corpora of compiled and decompiled source code on Spark."""
