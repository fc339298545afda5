"""Operations of a training-data pipeline over documents, vectors and chats.

Nothing else in the library imports this package; ``__spark_entry__.py`` adds its
queries when it is present.
"""
