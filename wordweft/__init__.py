"""wordweft: raw multilingual text to training data and static word vectors, as Spark jobs."""
