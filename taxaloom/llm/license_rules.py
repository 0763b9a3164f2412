"""Signatures of licences, as one ordered table of patterns over lower-cased words parted by single blanks.

Each rule: label, priority, words that every match holds (parted by blanks; ``a|b`` is either), pattern.  Where two rules meet on one passage, the
higher priority speaks, then the longer match, then the rule that stands first.  ``{...}`` names a fragment below.
"""

from __future__ import annotations

TAG, GRANT, TEXT, VERSIONED, NAMED, VAGUE = 95, 85, 75, 65, 50, 20

#: How sure a label of this priority is.
CONFIDENCE = {TAG: 0.99, GRANT: 0.95, TEXT: 0.9, VERSIONED: 0.8, NAMED: 0.6, VAGUE: 0.2}

FRAGMENTS = {
    "{lic}": "licen[sc]e",
    "{licd}": "licen[sc]ed",
    "{v}": "(?:versions? |ver ?|rev |v ?)?",
    "{gap}": "(?:[^ ]+ ){0,4}",
    "{later}": "(?:or|and) (?:at your option )?(?:any )?(?:later|newer|above|higher|greater)",
    "{spdx}": "spdx {lic} identifier",
    "{are}": "(?:is |are |be |being |was )?(?:hereby )?(?:{licd}|released|distributed|available|provided|covered|published|offered|governed|redistributed)",
    "{under}": "(?:under|by|with|according to|pursuant to|subject to) (?:the )?(?:terms (?:and conditions )?of )?(?:the |a |an )?",
}

#: The four phrases that are always reported, each place of them, whatever covers them.
BASE = [
    ("gpl", NAMED, "gnu", "gnu general public license"),
    ("apache", NAMED, "apache", "apache license"),
    ("cc-by", NAMED, "cc", "cc by"),
    ("mit", NAMED, "mit", "mit license"),
]

GNU = [
    ("gpl-1.0", TAG, "spdx gpl", "{spdx} gpl 1 0(?: only)?"),
    ("gpl-1.0-or-later", TAG, "spdx gpl", "{spdx} gpl 1 0 or later"),
    ("gpl-2.0", TAG, "spdx gpl", "{spdx} gpl 2 0(?: only)?"),
    ("gpl-2.0-or-later", TAG, "spdx gpl", "{spdx} gpl 2 0 or later"),
    ("gpl-3.0", TAG, "spdx gpl", "{spdx} gpl 3 0(?: only)?"),
    ("gpl-3.0-or-later", TAG, "spdx gpl", "{spdx} gpl 3 0 or later"),
    ("lgpl-2.0", TAG, "spdx lgpl", "{spdx} lgpl 2 0(?: only| or later)?"),
    ("lgpl-2.1", TAG, "spdx lgpl", "{spdx} lgpl 2 1(?: only)?"),
    ("lgpl-2.1-or-later", TAG, "spdx lgpl", "{spdx} lgpl 2 1 or later"),
    ("lgpl-3.0", TAG, "spdx lgpl", "{spdx} lgpl 3 0(?: only| or later)?"),
    ("agpl-3.0", TAG, "spdx agpl", "{spdx} agpl 3 0(?: only| or later)?"),
    ("gfdl-1.3", TAG, "spdx gfdl", "{spdx} gfdl 1 [123](?: only| or later)?"),
    ("gpl-1.0-or-later", GRANT, "gnu general public", "gnu general public {lic} as published by the free software foundation either version 1 (?:of the {lic} )?{later}"),
    ("gpl-2.0-or-later", GRANT, "gnu general public", "gnu general public {lic} as published by the free software foundation either version 2 (?:of the {lic} )?{later}"),
    ("gpl-3.0-or-later", GRANT, "gnu general public", "gnu general public {lic} as published by the free software foundation either version 3 (?:of the {lic} )?{later}"),
    ("gpl-2.0", GRANT, "gnu general public", "gnu general public {lic} version 2 (?:only )?as published by the free software foundation"),
    ("gpl-3.0", GRANT, "gnu general public", "gnu general public {lic} version 3 (?:only )?as published by the free software foundation"),
    ("lgpl-2.0-or-later", GRANT, "gnu library public", "gnu library general public {lic} as published by the free software foundation either version 2 (?:of the {lic} )?{later}"),
    ("lgpl-2.1-or-later", GRANT, "gnu lesser public", "gnu lesser general public {lic} as published by the free software foundation either version 2 1 (?:of the {lic} )?{later}"),
    ("lgpl-3.0-or-later", GRANT, "gnu lesser public", "gnu lesser general public {lic} as published by the free software foundation either version 3 (?:of the {lic} )?{later}"),
    ("agpl-3.0-or-later", GRANT, "gnu affero public", "gnu affero general public {lic} as published by the free software foundation either version 3 (?:of the {lic} )?{later}"),
    ("gfdl-1.1", GRANT, "gnu documentation", "gnu free documentation {lic} version 1 1 {later}"),
    ("gfdl-1.2", GRANT, "gnu documentation", "gnu free documentation {lic} version 1 2 {later}"),
    ("gfdl-1.3", GRANT, "gnu documentation", "gnu free documentation {lic} version 1 3 {later}"),
    ("gpl-2.0", TEXT, "gnu june 1991", "gnu general public {lic} version 2 june 1991"),
    ("gpl-3.0", TEXT, "gnu june 2007", "gnu general public {lic} version 3 29 june 2007"),
    ("lgpl-2.1", TEXT, "gnu lesser 1999", "gnu lesser general public {lic} version 2 1 february 1999"),
    ("lgpl-3.0", TEXT, "gnu lesser 2007", "gnu lesser general public {lic} version 3 29 june 2007"),
    ("agpl-3.0", TEXT, "gnu affero 2007", "gnu affero general public {lic} version 3 19 november 2007"),
    ("gpl", TEXT, "freedom share", "designed to take away your freedom to share and change it"),
    ("gpl", TEXT, "warranty merchantability gnu", "without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general public {lic}"),
    ("gpl-1.0", VERSIONED, "general public", "(?:gnu )?general public {lic} {v}1(?: 0)?"),
    ("gpl-2.0", VERSIONED, "general public", "(?:gnu )?general public {lic} (?:gpl )?{v}2(?: 0)?"),
    ("gpl-3.0", VERSIONED, "general public", "(?:gnu )?general public {lic} (?:gpl )?{v}3(?: 0)?"),
    ("gpl-2.0-or-later", VERSIONED, "general public", "(?:gnu )?general public {lic} (?:gpl )?{v}2(?: 0)? {later}"),
    ("gpl-3.0-or-later", VERSIONED, "general public", "(?:gnu )?general public {lic} (?:gpl )?{v}3(?: 0)? {later}"),
    ("gpl-2.0", VERSIONED, "gpl", "(?:gnu )?gpl {v}2(?: 0)?"),
    ("gpl-3.0", VERSIONED, "gpl", "(?:gnu )?gpl {v}3(?: 0)?"),
    ("gpl-2.0", VERSIONED, "gplv2", "(?:gnu )?gplv2"),
    ("gpl-3.0", VERSIONED, "gplv3", "(?:gnu )?gplv3"),
    ("gpl-2.0-or-later", VERSIONED, "gpl", "(?:gnu )?gpl {v}2(?: 0)? {later}"),
    ("gpl-3.0-or-later", VERSIONED, "gpl", "(?:gnu )?gpl {v}3(?: 0)? {later}"),
    ("gpl-2.0-or-later", VERSIONED, "gplv2", "(?:gnu )?gplv2 {later}"),
    ("gpl-3.0-or-later", VERSIONED, "gplv3", "(?:gnu )?gplv3 {later}"),
    ("lgpl-2.0", VERSIONED, "library general public", "(?:gnu )?library general public {lic} {v}2(?: 0)?"),
    ("lgpl-2.1", VERSIONED, "lesser general public", "(?:gnu )?lesser general public {lic} (?:lgpl )?{v}2 1"),
    ("lgpl-3.0", VERSIONED, "lesser general public", "(?:gnu )?lesser general public {lic} (?:lgpl )?{v}3(?: 0)?"),
    ("lgpl-2.1", VERSIONED, "lgpl|lgplv2", "(?:gnu )?(?:lgpl {v}2 1|lgplv2 1)"),
    ("lgpl-3.0", VERSIONED, "lgpl|lgplv3", "(?:gnu )?(?:lgpl {v}3(?: 0)?|lgplv3)"),
    ("agpl-3.0", VERSIONED, "affero general public", "(?:gnu )?affero general public {lic} (?:agpl )?{v}3(?: 0)?"),
    ("agpl-3.0", VERSIONED, "agpl|agplv3", "(?:gnu )?(?:agpl {v}3(?: 0)?|agplv3)"),
    ("gfdl-1.2", VERSIONED, "free documentation", "(?:gnu )?free documentation {lic} {v}1 2"),
    ("gfdl-1.3", VERSIONED, "free documentation", "(?:gnu )?free documentation {lic} {v}1 3"),
    ("gpl-classpath", VERSIONED, "classpath exception", "(?:gpl |gplv2 |{lic} )?(?:with |plus )?(?:the )?classpath exception"),
    ("gcc-exception", VERSIONED, "gcc runtime exception", "gcc runtime library exception(?: {v}3 1)?"),
    ("gpl", NAMED, "gpl", "(?:gnu )?gpl(?: {lic})?"),
    ("gpl", NAMED, "general public", "general public {lic}"),
    ("lgpl", NAMED, "lesser general public", "(?:gnu )?lesser general public {lic}"),
    ("lgpl", NAMED, "library general public", "(?:gnu )?library general public {lic}"),
    ("lgpl", NAMED, "lgpl", "(?:gnu )?lgpl(?: {lic})?"),
    ("agpl", NAMED, "affero", "(?:gnu )?affero (?:general public )?{lic}"),
    ("agpl", NAMED, "agpl", "(?:gnu )?agpl(?: {lic})?"),
    ("gfdl", NAMED, "free documentation", "(?:gnu )?free documentation {lic}"),
    ("gfdl", NAMED, "gfdl", "(?:gnu )?gfdl"),
]

APACHE_MIT_BSD = [
    ("apache-2.0", TAG, "spdx apache", "{spdx} apache 2 0"),
    ("apache-1.1", TAG, "spdx apache", "{spdx} apache 1 [01]"),
    ("mit", TAG, "spdx mit", "{spdx} mit"),
    ("mit-0", TAG, "spdx mit", "{spdx} mit 0"),
    ("bsd-2-clause", TAG, "spdx bsd", "{spdx} bsd 2 clause"),
    ("bsd-3-clause", TAG, "spdx bsd", "{spdx} bsd 3 clause"),
    ("bsd-4-clause", TAG, "spdx bsd", "{spdx} bsd 4 clause"),
    ("0bsd", TAG, "spdx 0bsd", "{spdx} 0bsd"),
    ("isc", TAG, "spdx isc", "{spdx} isc"),
    ("zlib", TAG, "spdx zlib", "{spdx} zlib"),
    ("bsl-1.0", TAG, "spdx bsl", "{spdx} bsl 1 0"),
    ("unlicense", TAG, "spdx unlicense", "{spdx} unlicense"),
    ("wtfpl", TAG, "spdx wtfpl", "{spdx} wtfpl"),
    ("mpl-2.0", TAG, "spdx mpl", "{spdx} mpl 2 0"),
    ("mpl-1.1", TAG, "spdx mpl", "{spdx} mpl 1 [01]"),
    ("epl-2.0", TAG, "spdx epl", "{spdx} epl 2 0"),
    ("epl-1.0", TAG, "spdx epl", "{spdx} epl 1 0"),
    ("apache-2.0", GRANT, "apache compliance", "{licd} under the apache {lic} version 2 0 the {lic} you may not use this file except in compliance with the {lic}"),
    ("apache-2.0", GRANT, "apache", "{are} {under}apache(?: software)? {lic} {v}2(?: 0)?"),
    ("apache-2.0", TEXT, "apache january 2004", "apache {lic} version 2 0 january 2004"),
    ("apache-2.0", TEXT, "licenses 2 0", "www apache org licenses {lic} 2 0(?: txt| html)?"),
    ("apache-1.1", TEXT, "apache", "this product includes software developed by the apache (?:software foundation|group)"),
    ("apache-2.0", VERSIONED, "apache", "apache(?: software)?(?: public)? {lic} {v}2(?: 0)?"),
    ("apache-2.0", VERSIONED, "apache", "apache 2(?: 0)?(?: {lic})?"),
    ("apache-1.1", VERSIONED, "apache", "apache(?: software)? {lic} {v}1 1"),
    ("apache-1.0", VERSIONED, "apache", "apache(?: software)? {lic} {v}1 0"),
    ("apache-2.0", VERSIONED, "asl", "asl 2(?: 0)?"),
    ("apache-2.0-llvm", VERSIONED, "llvm exceptions|exception", "(?:apache {lic} (?:v2 0|{v}2 0) )?with llvm exceptions?"),
    ("apache", NAMED, "apache software", "apache software {lic}"),
    ("apache", NAMED, "apache licensed|licenced", "apache {licd}"),
    ("mit", GRANT, "permission granted charge", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mit", TEXT, "copyright permission notice substantial", "the above copyright notice and this permission notice(?: including the next paragraph)? shall be included in all copies or substantial portions of the software"),
    ("mit", GRANT, "mit", "{are} {under}mit(?: x11| expat)? {lic}"),
    ("mit", VERSIONED, "opensource licenses mit", "opensource org licenses mit(?: {lic})?(?: php| html)?"),
    ("mit", NAMED, "mit", "mit (?:x11 |expat )?{lic}"),
    ("mit", NAMED, "mit licensed|licenced", "mit {licd}"),
    ("mit", NAMED, "expat", "expat {lic}"),
    ("mit-0", NAMED, "mit attribution", "mit no attribution"),
    ("x11", NAMED, "x11", "x11 {lic}"),
    ("x11", TEXT, "consortium advertising", "the name of the x consortium shall not be used in advertising"),
    ("bsd", GRANT, "redistribution binary modification", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("bsd-3-clause", TEXT, "endorse promote", "neither the names? of {gap}nor the names of (?:its|any|their) {gap}may be used to endorse or promote products derived from this software"),
    ("bsd-4-clause", TEXT, "advertising acknowledgement|acknowledgment", "all advertising materials mentioning features or use of this software must display the following acknowledge?ment"),
    ("bsd-2-clause", VERSIONED, "bsd|freebsd", "(?:bsd 2 clause|2 clause bsd|two clause bsd|simplified bsd|freebsd)(?: {lic})?"),
    ("bsd-3-clause", VERSIONED, "bsd", "(?:bsd 3 clause|3 clause bsd|three clause bsd|new bsd|modified bsd|revised bsd)(?: {lic})?"),
    ("bsd-4-clause", VERSIONED, "bsd", "(?:bsd 4 clause|4 clause bsd|four clause bsd|original bsd|old bsd)(?: {lic})?"),
    ("0bsd", VERSIONED, "bsd", "zero clause bsd(?: {lic})?"),
    ("0bsd", NAMED, "0bsd", "0bsd"),
    ("bsd", NAMED, "bsd", "bsd (?:style )?{lic}"),
    ("bsd", NAMED, "bsd licensed|licenced", "bsd {licd}"),
    ("isc", TEXT, "permission fee granted", "permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted"),
    ("isc", NAMED, "isc", "isc {lic}"),
    ("zlib", TEXT, "express implied held", "this software is provided as is without any express or implied warranty in no event will the authors be held liable"),
    ("zlib", NAMED, "zlib", "zlib(?: libpng)? {lic}"),
    ("libpng", NAMED, "libpng", "libpng {lic}"),
    ("bsl-1.0", TEXT, "boost august 2003", "boost software {lic} version 1 0 august 17(?:th)? 2003"),
    ("bsl-1.0", VERSIONED, "boost software", "boost software {lic}(?: {v}1 0)?"),
    ("ncsa", NAMED, "ncsa", "(?:university of illinois )?ncsa (?:open source )?{lic}"),
    ("curl", NAMED, "curl", "curl {lic}"),
    ("postgresql", NAMED, "postgresql", "postgresql {lic}"),
    ("openssl", NAMED, "openssl", "openssl {lic}"),
    ("openssl", TEXT, "openssl toolkit", "this product includes software developed by the openssl project for use in the openssl toolkit"),
    ("ssleay", TEXT, "eric young", "this product includes cryptographic software written by eric young"),
    ("unlicense", TEXT, "unencumbered", "this is free and unencumbered software released into the public domain"),
    ("unlicense", NAMED, "unlicense", "(?:the )?unlicense"),
    ("wtfpl", NAMED, "wtfpl", "wtfpl(?: {v}2)?"),
    ("wtfpl", TEXT, "fuck public", "do what the fuck you want to public {lic}"),
    ("beerware", TEXT, "beer worth", "if we meet some day and you think this stuff is worth it you can buy me a beer"),
    ("beerware", NAMED, "beer ware", "beer ware {lic}"),
    ("blueoak-1.0", NAMED, "blue oak", "blue oak model {lic}(?: 1 0 0)?"),
    ("afl-3.0", VERSIONED, "academic free", "academic free {lic} {v}3(?: 0)?"),
    ("afl-2.1", VERSIONED, "academic free", "academic free {lic} {v}2 [01]"),
    ("afl", NAMED, "academic free", "academic free {lic}"),
    ("ecl-2.0", NAMED, "educational community", "educational community {lic}(?: {v}[12] 0)?"),
    ("upl-1.0", NAMED, "universal permissive", "universal permissive {lic}(?: {v}1 0)?"),
    ("ms-pl", NAMED, "microsoft public", "microsoft public {lic}"),
    ("ms-rl", NAMED, "microsoft reciprocal", "microsoft reciprocal {lic}"),
    ("w3c", NAMED, "w3c", "w3c (?:software |document )?(?:notice and )?{lic}"),
    ("unicode", NAMED, "unicode", "unicode (?:data files and software )?{lic}(?: agreement)?"),
    ("icu", NAMED, "icu", "icu {lic}"),
    ("python-2.0", VERSIONED, "python foundation", "python software foundation {lic} {v}2(?: 0)?"),
    ("python-2.0", NAMED, "psf", "psf {lic}(?: agreement)?"),
    ("python-2.0", NAMED, "python foundation", "python software foundation {lic}"),
    ("php-3.01", VERSIONED, "php", "php {lic} {v}3(?: 0| 01)?"),
    ("php", NAMED, "php", "php {lic}"),
    ("ruby", NAMED, "ruby", "ruby {lic}"),
    ("tcl", NAMED, "tcl", "tcl(?: tk)? {lic}"),
    ("zpl-2.1", NAMED, "zope", "zope public {lic}(?: {v}2 [01])?"),
    ("vim", NAMED, "vim", "vim {lic}"),
    ("freetype", NAMED, "freetype", "freetype (?:project )?{lic}"),
    ("ijg", NAMED, "jpeg group", "independent jpeg group(?: s)? {lic}"),
    ("ijg", TEXT, "jpeg group", "this software is based in part on the work of the independent jpeg group"),
    ("imagemagick", NAMED, "imagemagick", "imagemagick {lic}"),
    ("mulan-2.0", NAMED, "mulan", "mulan (?:psl|permissive software {lic})(?: v2|{v}2)?"),
    ("artistic-1.0", VERSIONED, "artistic", "artistic {lic} {v}1(?: 0)?"),
    ("artistic-2.0", VERSIONED, "artistic", "artistic {lic} {v}2(?: 0)?"),
    ("artistic", NAMED, "artistic", "(?:perl )?artistic {lic}"),
    ("perl", GRANT, "perl itself", "under the same terms as perl(?: [56](?: [0-9]+)*)? itself"),
    ("json", TEXT, "good evil", "(?:the )?software shall be used for good not evil"),
]

RECIPROCAL = [
    ("mpl-1.0", VERSIONED, "mozilla public", "mozilla public {lic} {v}1 0"),
    ("mpl-1.1", VERSIONED, "mozilla public", "mozilla public {lic} (?:mpl )?{v}1 1"),
    ("mpl-2.0", VERSIONED, "mozilla public", "mozilla public {lic} (?:mpl )?{v}2(?: 0)?"),
    ("mpl-2.0", GRANT, "mozilla subject", "this source code form is subject to the terms of the mozilla public {lic} {v}2 0"),
    ("mpl-1.1", GRANT, "mozilla contents subject", "the contents of this file are subject to the mozilla public {lic} version 1 1"),
    ("mpl-2.0", VERSIONED, "mpl", "mpl {v}2(?: 0)?"),
    ("mpl", NAMED, "mozilla public", "mozilla public {lic}"),
    ("epl-1.0", VERSIONED, "eclipse public", "eclipse public {lic} {v}1(?: 0)?"),
    ("epl-2.0", VERSIONED, "eclipse public", "eclipse public {lic} {v}2(?: 0)?"),
    ("epl", NAMED, "eclipse public", "eclipse public {lic}"),
    ("edl-1.0", NAMED, "eclipse distribution", "eclipse distribution {lic}(?: {v}1 0)?"),
    ("cddl-1.0", VERSIONED, "common development distribution", "common development and distribution {lic} (?:cddl )?{v}1 0"),
    ("cddl-1.1", VERSIONED, "common development distribution", "common development and distribution {lic} (?:cddl )?{v}1 1"),
    ("cddl", NAMED, "common development distribution", "common development and distribution {lic}"),
    ("cddl", NAMED, "cddl", "cddl(?: {v}1 [01])?"),
    ("cpl-1.0", NAMED, "common public", "common public {lic}(?: {v}1 0)?"),
    ("cpal-1.0", NAMED, "common public attribution", "common public attribution {lic}(?: {v}1 0)?"),
    ("ipl-1.0", NAMED, "ibm public", "ibm public {lic}(?: {v}1 0)?"),
    ("npl-1.1", NAMED, "netscape public", "netscape public {lic}(?: {v}1 [01])?"),
    ("apsl-2.0", NAMED, "apple public source", "apple public source {lic}(?: {v}[12](?: [0-2])?)?"),
    ("spl-1.0", NAMED, "sun public", "sun public {lic}(?: {v}1 0)?"),
    ("sissl", NAMED, "sun industry standards", "sun industry standards source {lic}"),
    ("qpl-1.0", NAMED, "q public", "q public {lic}(?: {v}1 0)?"),
    ("osl-3.0", VERSIONED, "open software", "open software {lic} {v}3(?: 0)?"),
    ("osl-2.1", VERSIONED, "open software", "open software {lic} {v}[12] [01]"),
    ("osl", NAMED, "open software", "open software {lic}"),
    ("eupl-1.1", VERSIONED, "eupl", "eupl {v}1 1"),
    ("eupl-1.2", VERSIONED, "eupl", "eupl {v}1 2"),
    ("eupl", NAMED, "european union public", "european union public {lic}(?: eupl)?(?: {v}1 [012])?"),
    ("cecill-2.1", VERSIONED, "cecill", "cecill(?: {lic})? {v}2(?: [01])?"),
    ("cecill-b", VERSIONED, "cecill", "cecill b"),
    ("cecill-c", VERSIONED, "cecill", "cecill c"),
    ("cecill", NAMED, "cecill", "cecill(?: free software)?(?: {lic})?"),
    ("rpl-1.5", NAMED, "reciprocal public", "reciprocal public {lic}(?: {v}1 [0-9])?"),
    ("lppl-1.3c", VERSIONED, "latex project", "latex project public {lic} {v}1 3c?"),
    ("lppl", NAMED, "latex project", "latex project public {lic}"),
    ("lppl", NAMED, "lppl", "lppl(?: {v}1 [0-3]c?)?"),
    ("sleepycat", NAMED, "sleepycat", "sleepycat (?:public )?{lic}"),
    ("watcom-1.0", NAMED, "watcom", "sybase open watcom public {lic}"),
    ("nasa-1.3", NAMED, "nasa", "nasa open source agreement(?: {v}1 3)?"),
    ("sspl-1.0", NAMED, "server side public", "server side public {lic}(?: {v}1)?"),
    ("sspl-1.0", NAMED, "sspl", "sspl(?: {v}1(?: 0)?)?"),
    ("busl-1.1", NAMED, "business source", "business source {lic}(?: {v}1 1)?"),
    ("elastic-2.0", NAMED, "elastic", "elastic {lic}(?: {v}2(?: 0)?)?"),
    ("commons-clause", NAMED, "commons clause", "commons clause(?: {lic})?(?: condition)?(?: {v}1 0)?"),
    ("polyform", NAMED, "polyform", "polyform (?:noncommercial|shield|small business|internal use|free trial|perimeter|strict)(?: {lic})?(?: 1 0 0)?"),
    ("confluent", NAMED, "confluent community", "confluent community {lic}"),
    ("timescale", NAMED, "timescale", "timescale {lic}"),
]

CONTENT = [
    ("cc0-1.0", TAG, "spdx cc0", "{spdx} cc0 1 0"),
    ("cc-by-4.0", TAG, "spdx cc by", "{spdx} cc by 4 0"),
    ("cc-by-sa-4.0", TAG, "spdx cc by sa", "{spdx} cc by sa 4 0"),
    ("cc-by-nc-4.0", TAG, "spdx cc by nc", "{spdx} cc by nc 4 0"),
    ("cc0-1.0", VERSIONED, "cc0", "cc0(?: 1 0)?(?: universal)?"),
    ("cc0-1.0", VERSIONED, "creative zero", "creative commons (?:cc )?zero(?: {v}1 0)?"),
    ("cc0-1.0", TEXT, "publicdomain zero", "creativecommons org publicdomain zero 1 0"),
    ("cc-pdm", NAMED, "public domain mark", "public domain mark(?: 1 0)?"),
    ("cc-by-1.0", VERSIONED, "cc by", "cc by {v}1 0"),
    ("cc-by-2.0", VERSIONED, "cc by", "cc by {v}2 0"),
    ("cc-by-2.5", VERSIONED, "cc by", "cc by {v}2 5"),
    ("cc-by-3.0", VERSIONED, "cc by", "cc by {v}3 0"),
    ("cc-by-4.0", VERSIONED, "cc by", "cc by {v}4 0"),
    ("cc-by-sa-2.0", VERSIONED, "cc by sa", "cc by sa {v}2 [05]"),
    ("cc-by-sa-3.0", VERSIONED, "cc by sa", "cc by sa {v}3 0"),
    ("cc-by-sa-4.0", VERSIONED, "cc by sa", "cc by sa {v}4 0"),
    ("cc-by-nc-2.0", VERSIONED, "cc by nc", "cc by nc {v}2 [05]"),
    ("cc-by-nc-3.0", VERSIONED, "cc by nc", "cc by nc {v}3 0"),
    ("cc-by-nc-4.0", VERSIONED, "cc by nc", "cc by nc {v}4 0"),
    ("cc-by-nd-3.0", VERSIONED, "cc by nd", "cc by nd {v}3 0"),
    ("cc-by-nd-4.0", VERSIONED, "cc by nd", "cc by nd {v}4 0"),
    ("cc-by-nc-sa-3.0", VERSIONED, "cc by nc sa", "cc by nc sa {v}3 0"),
    ("cc-by-nc-sa-4.0", VERSIONED, "cc by nc sa", "cc by nc sa {v}4 0"),
    ("cc-by-nc-nd-3.0", VERSIONED, "cc by nc nd", "cc by nc nd {v}3 0"),
    ("cc-by-nc-nd-4.0", VERSIONED, "cc by nc nd", "cc by nc nd {v}4 0"),
    ("cc-by-sa", NAMED, "cc by sa", "cc by sa"),
    ("cc-by-nc", NAMED, "cc by nc", "cc by nc"),
    ("cc-by-nd", NAMED, "cc by nd", "cc by nd"),
    ("cc-by-nc-sa", NAMED, "cc by nc sa", "cc by nc sa"),
    ("cc-by-nc-nd", NAMED, "cc by nc nd", "cc by nc nd"),
    ("cc-by-4.0", TEXT, "creativecommons licenses by", "creativecommons org licenses by 4 0"),
    ("cc-by-3.0", TEXT, "creativecommons licenses by", "creativecommons org licenses by 3 0"),
    ("cc-by-sa-4.0", TEXT, "creativecommons licenses by sa", "creativecommons org licenses by sa 4 0"),
    ("cc-by-sa-3.0", TEXT, "creativecommons licenses by sa", "creativecommons org licenses by sa 3 0"),
    ("cc-by-nc-4.0", TEXT, "creativecommons licenses by nc", "creativecommons org licenses by nc 4 0"),
    ("cc-by-nc-sa-4.0", TEXT, "creativecommons licenses by nc sa", "creativecommons org licenses by nc sa 4 0"),
    ("cc-by-nc-nd-4.0", TEXT, "creativecommons licenses by nc nd", "creativecommons org licenses by nc nd 4 0"),
    ("cc-by-4.0", VERSIONED, "creative attribution", "creative commons attribution {v}4 0"),
    ("cc-by-3.0", VERSIONED, "creative attribution", "creative commons attribution {v}3 0"),
    ("cc-by-2.0", VERSIONED, "creative attribution", "creative commons attribution {v}2 [05]"),
    ("cc-by-sa-4.0", VERSIONED, "creative attribution", "creative commons attribution share ?alike {v}4 0"),
    ("cc-by-sa-3.0", VERSIONED, "creative attribution", "creative commons attribution share ?alike {v}3 0"),
    ("cc-by-nc-4.0", VERSIONED, "creative attribution", "creative commons attribution non ?commercial {v}4 0"),
    ("cc-by-nc-3.0", VERSIONED, "creative attribution", "creative commons attribution non ?commercial {v}3 0"),
    ("cc-by-nd-4.0", VERSIONED, "creative attribution", "creative commons attribution no ?deriv(?:ative)?s {v}4 0"),
    ("cc-by-nc-sa-4.0", VERSIONED, "creative attribution", "creative commons attribution non ?commercial share ?alike {v}4 0"),
    ("cc-by-nc-nd-4.0", VERSIONED, "creative attribution", "creative commons attribution non ?commercial no ?deriv(?:ative)?s {v}4 0"),
    ("cc-by", NAMED, "creative attribution", "creative commons attribution(?: {lic})?"),
    ("cc-by-sa", NAMED, "creative attribution", "creative commons attribution share ?alike(?: {lic})?"),
    ("cc-by-nc", NAMED, "creative attribution", "creative commons attribution non ?commercial(?: {lic})?"),
    ("cc", NAMED, "creative commons", "creative commons(?: public)?(?: {lic})?"),
    ("ofl-1.1", NAMED, "sil open font", "sil open font {lic}(?: {v}1 [01])?"),
    ("ofl-1.1", NAMED, "open font", "open font {lic}(?: {v}1 [01])?"),
    ("odbl-1.0", NAMED, "open database", "open (?:data commons open )?database {lic}(?: odbl)?(?: {v}1 0)?"),
    ("odbl-1.0", NAMED, "odbl", "odbl(?: {v}1 0)?"),
    ("odc-by-1.0", NAMED, "open data attribution", "open data commons attribution {lic}(?: {v}1 0)?"),
    ("pddl-1.0", NAMED, "public domain dedication", "public domain dedication (?:and )?{lic}(?: {v}1 0)?"),
    ("cdla-permissive", NAMED, "community data agreement", "community data {lic} agreement permissive(?: {v}[12] 0)?"),
    ("cdla-sharing", NAMED, "community data agreement", "community data {lic} agreement sharing(?: {v}1 0)?"),
    ("ogl-uk-3.0", NAMED, "open government", "open government {lic}(?: {v}[123](?: 0)?)?"),
    ("etalab-2.0", NAMED, "licence ouverte", "licence ouverte(?: {v}[12](?: 0)?)?"),
    ("free-art-1.3", NAMED, "free art", "free art {lic}(?: {v}1 [23])?"),
    ("opl-1.0", NAMED, "open publication", "open publication {lic}(?: {v}[01] [04])?"),
    ("openrail", NAMED, "openrail", "(?:bigscience |creativeml )?(?:bigcode )?openrail(?: [ms])?(?: {lic})?"),
    ("rail", NAMED, "responsible ai", "responsible ai {lic}s?"),
    ("llama", NAMED, "llama community", "llama (?:[23](?: [0-9])? )?community {lic}(?: agreement)?"),
    ("public-domain", TEXT, "public domain", "(?:released|placed|dedicated|put|donated) (?:in|into|to) the public domain"),
    ("public-domain", NAMED, "public domain", "(?:is|are) in the public domain"),
]

OWNERSHIP = [
    ("proprietary", TEXT, "confidential proprietary", "confidential and proprietary(?: information)?"),
    ("proprietary", TEXT, "unauthorized|unauthorised prohibited", "unauthori[sz]ed (?:copying|use|reproduction|distribution) {gap}(?:is )?(?:strictly )?prohibited"),
    ("proprietary", TEXT, "prior written permission|consent", "(?:may not be|no part of this [^ ]+ may be) (?:reproduced|copied|redistributed|republished) {gap}{gap}without {gap}prior written (?:permission|consent)"),
    ("proprietary", NAMED, "proprietary", "proprietary (?:software )?{lic}"),
    ("eula", NAMED, "end user", "end user {lic} agreement"),
    ("eula", NAMED, "eula", "eula"),
    ("non-commercial", NAMED, "use only commercial|noncommercial", "for non ?commercial use only"),
    ("non-commercial", NAMED, "academic use only", "for academic (?:and research )?use only"),
    ("trial", NAMED, "evaluation", "for evaluation purposes only"),
    ("no-warranty", VAGUE, "warranty", "(?:without|no) warranty (?:of any kind|express or implied)"),
    ("all-rights-reserved", VAGUE, "rights reserved", "all rights reserved"),
    ("all-rights-reserved", VAGUE, "tous droits", "tous droits réservés"),
    ("all-rights-reserved", VAGUE, "alle rechte", "alle rechte vorbehalten"),
    ("all-rights-reserved", VAGUE, "todos los derechos", "todos los derechos reservados"),
    ("copyright", VAGUE, "copyright", "copyright (?:c |© )?(?:19|20)[0-9][0-9](?: (?:19|20)[0-9][0-9])*"),
    ("some-licence", VAGUE, "license|licence", "{are} under (?:the |this |a |an )?(?:following |same |above |own |custom |separate |permissive |free )?{lic}"),
    ("some-licence", VAGUE, "license|licence", "see (?:the )?(?:file )?{lic}(?: file)?(?: txt| md)? for (?:details|more information|terms)"),
    ("some-licence", VAGUE, "open source", "(?:free and )?open source (?:software )?{lic}"),
    ("some-licence", VAGUE, "dual licensed|licenced", "dual {licd}"),
]

RULES = [*GNU, *APACHE_MIT_BSD, *RECIPROCAL, *CONTENT, *OWNERSHIP]
