import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

# texts that every operator over documents must take: null, empty, blank, other blanks, long, repeated
ODD_TEXTS = [None, "", " \n\t ", "one", "a\x85b c d\x1ce", "é😀 中文 ﬁ " * 3, "word " * 20_000, "same text here " * 10,
             "same text here " * 10]
