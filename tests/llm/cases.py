"""Rows that every operator must get through."""

LONG = "Ein langer Text " * 15000
EDGES = [
    (1, None, "en", "src0"), (2, "", "en", "src0"), (3, " \t\n\r\x0b\x0c ", None, "src1"), (4, "one", "en", None),
    (5, LONG, "de", "src2"), (6, LONG, "de", "src2"), (7, "Same words in a short row of text", "en", "src0"),
    (7, "Same words in a short row of text", "en", "src0"), (8, "Same words in a short row of text", "en", "src3"),
    (None, "A row without any id", "en", "src0"), (None, None, None, None), (9, "emoji 😀 ünïcode ß ſ K \x1c x", "fr", "src9"),
    (10, "<|im_start|>assistant<|im_sep|> <\\|x|> <<|\\", "es", "src7"), (11, "the end\n\nthe end\n\nthe end", "en", "src0")]
CLASHING = "kept_id,kept_digest,taken_id,taken_lang,taken_source,taken_copies,copy,nameless,is_past,score,digest,kept,key,comp,tokens,label,rep,n,spans,plan,at,a,b,u,v,low,shard,group,picked,word,bands,turns,rows,weight,budget,range,copies"
SCHEMA = "doc_id long, text string, lang string, source string"


def edge_docs(spark):
    """The edge rows with further columns named like the operators' own."""
    docs = spark.createDataFrame(EDGES, SCHEMA)
    for name in CLASHING.split(","):
        docs = docs.selectExpr("*", f"'x' as {name}")
    return docs


def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def labels(spark, rows=()):
    return spark.createDataFrame(list(rows), "doc_id long, quality int, toxic int")


def documents(spark, folder, name="documents"):
    return spark.read.parquet(f"{folder}/{name}.parquet")
