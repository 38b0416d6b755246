from .alignments import flatten_trio, read_maf, read_maf_pairs, read_psl  # noqa: F401
from .features import read_gff, read_repeatmasker, read_tandem_repeats  # noqa: F401
from .sequences import on_grid, read_fasta, read_fasta_pieces, read_fastq, subsequence, subsequences, subsequences_of_pieces  # noqa: F401
from .tables import read_introns_json, read_metadata, read_spectra, read_trios  # noqa: F401
