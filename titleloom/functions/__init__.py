"""Column functions: text, URLs, HTML, MinHash and the Huffman codec."""
