"""Ordered signature rules for license scans.

A rule is (label, tier, keyword, pattern). Patterns are for lower-cased text, a blank
in them stands for any run of characters that are no letters or digits. A rule is tried
only on texts that hold its keyword besides one of ANCHORS, one of which stands in
every match too. Tiers order the rules: 1 tags, 2 notices, 3 full names with their versions,
4 names, 5 hints that some license is meant.
"""

from __future__ import annotations

import re

ANCHORS = ["licen", "copyright", "spdx", "redistribut", "warrant", "permission", "gpl", "domain", "copyleft"]
CONFIDENCE = {1: 1.0, 2: 0.95, 3: 0.9, 4: 0.75, 5: 0.4}

#: label, SPDX identifiers (patterns), names (patterns, without the word license).
FAMILIES = [
    ("mit", [r"mit", r"mit-0", r"x11", r"mit-modern-variant"], [r"mit", r"mit x11", r"expat", r"x11"]),
    ("apache", [r"apache-1\.0", r"apache-1\.1", r"apache-2\.0"], [r"apache", r"apache software", r"asl"]),
    ("gpl", [r"gpl-1\.0(?:-only|-or-later|\+)?", r"gpl-2\.0(?:-only|-or-later|\+)?", r"gpl-3\.0(?:-only|-or-later|\+)?"], [r"gnu general public", r"general public", r"gnu gpl", r"gpl"]),
    ("lgpl", [r"lgpl-2\.0(?:-only|-or-later|\+)?", r"lgpl-2\.1(?:-only|-or-later|\+)?", r"lgpl-3\.0(?:-only|-or-later|\+)?"], [r"gnu lesser general public", r"lesser general public", r"library general public", r"lgpl"]),
    ("agpl", [r"agpl-1\.0(?:-only|-or-later)?", r"agpl-3\.0(?:-only|-or-later|\+)?"], [r"gnu affero general public", r"affero general public", r"agpl"]),
    ("gfdl", [r"gfdl-1\.[123](?:-only|-or-later)?"], [r"gnu free documentation", r"gfdl"]),
    ("bsd", [r"bsd-1-clause", r"0bsd", r"bsd-4-clause"], [r"bsd", r"berkeley software distribution"]),
    ("bsd-2-clause", [r"bsd-2-clause(?:-patent)?"], [r"simplified bsd", r"freebsd", r"2 clause bsd", r"bsd 2 clause", r"two clause bsd"]),
    ("bsd-3-clause", [r"bsd-3-clause(?:-clear)?"], [r"new bsd", r"modified bsd", r"revised bsd", r"3 clause bsd", r"bsd 3 clause", r"three clause bsd"]),
    ("isc", [r"isc"], [r"isc", r"internet systems consortium"]),
    ("mpl", [r"mpl-1\.[01]", r"mpl-2\.0(?:-no-copyleft-exception)?"], [r"mozilla public", r"mpl"]),
    ("epl", [r"epl-1\.0", r"epl-2\.0"], [r"eclipse public", r"epl"]),
    ("edl", [r"edl-1\.0"], [r"eclipse distribution"]),
    ("cpl", [r"cpl-1\.0"], [r"common public", r"ibm public"]),
    ("cddl", [r"cddl-1\.[01]"], [r"common development and distribution", r"cddl"]),
    ("cpal", [r"cpal-1\.0"], [r"common public attribution"]),
    ("eupl", [r"eupl-1\.[012]"], [r"european union public", r"eupl"]),
    ("cecill", [r"cecill-(?:1\.0|1\.1|2\.0|2\.1|b|c)"], [r"cecill", r"cecill free software"]),
    ("artistic", [r"artistic-[12]\.0(?:-perl|-cl8)?"], [r"artistic", r"perl artistic", r"clarified artistic"]),
    ("bsl-1.0", [r"bsl-1\.0"], [r"boost software"]),
    ("busl", [r"busl-1\.1"], [r"business source"]),
    ("zlib", [r"zlib", r"zlib-acknowledgement"], [r"zlib", r"zlib libpng"]),
    ("libpng", [r"libpng(?:-2\.0)?"], [r"libpng", r"png reference library"]),
    ("unlicense", [r"unlicense"], [r"the unlicense"]),
    ("wtfpl", [r"wtfpl"], [r"do what the fuck you want to public", r"wtfpl"]),
    ("cc0", [r"cc0-1\.0"], [r"cc0", r"creative commons zero", r"cc zero"]),
    ("cc-by", [r"cc-by-[1-4]\.[05]"], [r"creative commons attribution", r"cc by"]),
    ("cc-by-sa", [r"cc-by-sa-[1-4]\.[05]"], [r"creative commons attribution share ?alike", r"cc by sa"]),
    ("cc-by-nc", [r"cc-by-nc-[1-4]\.[05]"], [r"creative commons attribution non ?commercial", r"cc by nc"]),
    ("cc-by-nd", [r"cc-by-nd-[1-4]\.[05]"], [r"creative commons attribution no ?deriv(?:ative)?s?", r"cc by nd"]),
    ("cc-by-nc-sa", [r"cc-by-nc-sa-[1-4]\.[05]"], [r"creative commons attribution non ?commercial share ?alike", r"cc by nc sa"]),
    ("cc-by-nc-nd", [r"cc-by-nc-nd-[1-4]\.[05]"], [r"creative commons attribution non ?commercial no ?deriv(?:ative)?s?", r"cc by nc nd"]),
    ("odbl", [r"odbl-1\.0"], [r"open database", r"odbl"]),
    ("odc-by", [r"odc-by-1\.0"], [r"open data commons attribution"]),
    ("pddl", [r"pddl-1\.0"], [r"open data commons public domain dedication", r"pddl"]),
    ("ofl", [r"ofl-1\.[01](?:-rfn|-no-rfn)?"], [r"sil open font", r"open font"]),
    ("python", [r"python-2\.0(?:\.1)?", r"psf-2\.0"], [r"python software foundation", r"psf", r"python"]),
    ("php", [r"php-3\.0", r"php-3\.01"], [r"php"]),
    ("ruby", [r"ruby"], [r"ruby"]),
    ("postgresql", [r"postgresql"], [r"postgresql"]),
    ("openssl", [r"openssl"], [r"openssl", r"ssleay"]),
    ("openldap", [r"oldap-[12]\.[0-9.]+"], [r"openldap public"]),
    ("curl", [r"curl"], [r"curl"]),
    ("ncsa", [r"ncsa"], [r"university of illinois ncsa open source", r"ncsa"]),
    ("w3c", [r"w3c(?:-19980720|-20150513)?"], [r"w3c software", r"w3c document", r"w3c"]),
    ("zope", [r"zpl-[12]\.[01]"], [r"zope public", r"zpl"]),
    ("vim", [r"vim"], [r"vim"]),
    ("tcl", [r"tcl"], [r"tcl tk", r"tcl"]),
    ("latex", [r"lppl-1\.[0-3][abc]?"], [r"latex project public", r"lppl"]),
    ("apple", [r"apsl-1\.[0-2]", r"apsl-2\.0"], [r"apple public source", r"apsl"]),
    ("ms-pl", [r"ms-pl"], [r"microsoft public", r"ms pl"]),
    ("ms-rl", [r"ms-rl"], [r"microsoft reciprocal", r"ms rl"]),
    ("osl", [r"osl-[123]\.[01]"], [r"open software"]),
    ("afl", [r"afl-[123]\.[012]"], [r"academic free"]),
    ("qpl", [r"qpl-1\.0"], [r"q public", r"qt public"]),
    ("sleepycat", [r"sleepycat"], [r"sleepycat", r"berkeley db"]),
    ("intel", [r"intel"], [r"intel open source", r"intel simplified software"]),
    ("nasa", [r"nasa-1\.3"], [r"nasa open source agreement"]),
    ("rpl", [r"rpl-1\.[15]"], [r"reciprocal public"]),
    ("sspl", [r"sspl-1\.0"], [r"server side public", r"sspl"]),
    ("elastic", [r"elastic-2\.0"], [r"elastic"]),
    ("mulan", [r"mulanpsl-[12]\.0"], [r"mulan permissive software", r"mulan psl"]),
    ("upl", [r"upl-1\.0"], [r"universal permissive"]),
    ("ecl", [r"ecl-[12]\.0"], [r"educational community"]),
    ("fair", [r"fair"], [r"fair"]),
    ("beerware", [r"beerware"], [r"beer ?ware", r"the beer ware"]),
    ("json", [r"json"], [r"json"]),
    ("unicode", [r"unicode-(?:dfs-201[56]|3\.0|tou)"], [r"unicode", r"unicode inc"]),
    ("icu", [r"icu"], [r"icu"]),
    ("blueoak", [r"blueoak-1\.0\.0"], [r"blue oak model"]),
    ("openrail", [r"(?:bigscience-)?openrail(?:-m)?"], [r"openrail", r"responsible ai", r"creativeml open rail m"]),
    ("hippocratic", [r"hippocratic-2\.[01]"], [r"hippocratic"]),
    ("watcom", [r"watcom-1\.0"], [r"sybase open watcom public"]),
    ("naumen", [r"naumen"], [r"naumen public"]),
    ("nokia", [r"nokia"], [r"nokia open source"]),
    ("sun", [r"spl-1\.0", r"sissl"], [r"sun public", r"sun industry standards source"]),
    ("ogl", [r"ogl-uk-[123]\.0"], [r"open government"]),
    ("parity", [r"parity-[67]\.0\.0"], [r"parity public"]),
    ("polyform", [r"polyform-(?:noncommercial|small-business)-1\.0\.0"], [r"polyform noncommercial", r"polyform small business"]),
]

#: Wording of notices and texts, and hints: label, tier, keyword, pattern.
NOTICES = [
    ("mit", 2, "permission", r"permission is hereby granted free of charge to any person obtaining a copy"),
    ("mit", 2, "permission", r"the above copyright notice and this permission notice shall be included in all copies"),
    ("isc", 2, "permission", r"permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted"),
    ("hpnd", 2, "permission", r"permission to use copy modify and distribute this software and its documentation for any purpose"),
    ("hpnd", 2, "permission", r"appear in all copies and that both that copyright notice and this permission notice appear in supporting documentation"),
    ("bsd", 2, "redistribut", r"redistribution and use in source and binary forms with or without modification are permitted"),
    ("bsd-2-clause", 2, "redistribut", r"redistributions in binary form must reproduce the above copyright notice"),
    ("bsd-2-clause", 2, "redistribut", r"redistributions of source code must retain the above copyright notice"),
    ("bsd-3-clause", 2, "permission", r"neither the name of .{1,80}? may be used to endorse or promote products .{1,60}? without specific prior written permission"),
    ("bsd-4-clause", 2, "copyright", r"all advertising materials mentioning features or use of this software must display"),
    ("apache", 2, "licen", r"licensed under the apache license version 2 0"),
    ("apache", 2, "licen", r"you may not use this file except in compliance with the license"),
    ("apache", 2, "licen", r"apache org licenses license 2 0"),
    ("apache", 2, "licen", r"licensed to the apache software foundation asf under one or more"),
    ("apache", 2, "warrant", r"distributed on an as is basis without warranties or conditions of any kind"),
    ("gpl", 2, "redistribut", r"you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl", 2, "redistribut", r"you can redistribute it and or modify it under the terms of the gnu lesser general public license"),
    ("lgpl", 2, "redistribut", r"you can redistribute it and or modify it under the terms of the gnu library general public license"),
    ("agpl", 2, "redistribut", r"you can redistribute it and or modify it under the terms of the gnu affero general public license"),
    ("gpl", 2, "licen", r"either version [123] of the license or at your option any later version"),
    ("gpl", 2, "licen", r"you should have received a copy of the gnu general public license along with"),
    ("lgpl", 2, "licen", r"you should have received a copy of the gnu lesser general public license along with"),
    ("agpl", 2, "licen", r"you should have received a copy of the gnu affero general public license along with"),
    ("gpl", 2, "licen", r"gnu org licenses gpl"),
    ("lgpl", 2, "licen", r"gnu org licenses lgpl"),
    ("agpl", 2, "licen", r"gnu org licenses agpl"),
    ("gfdl", 2, "permission", r"permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation"),
    ("mpl", 2, "licen", r"this source code form is subject to the terms of the mozilla public license"),
    ("mpl", 2, "licen", r"the contents of this file are subject to the mozilla public license"),
    ("mpl", 2, "licen", r"if a copy of the mpl was not distributed with this file"),
    ("epl", 2, "licen", r"made available under the terms of the eclipse public license"),
    ("epl", 2, "licen", r"eclipse org legal epl"),
    ("cddl", 2, "licen", r"subject to the terms of the common development and distribution license"),
    ("eupl", 2, "licen", r"licensed under the eupl"),
    ("bsl-1.0", 2, "licen", r"distributed under the boost software license version 1 0"),
    ("bsl-1.0", 2, "permission", r"permission is hereby granted free of charge to any person or organization obtaining a copy of the software"),
    ("zlib", 2, "warrant", r"this software is provided as is without any express or implied warranty"),
    ("zlib", 2, "permission", r"permission is granted to anyone to use this software for any purpose"),
    ("zlib", 2, "redistribut", r"the origin of this software must not be misrepresented"),
    ("unlicense", 2, "domain", r"this is free and unencumbered software released into the public domain"),
    ("unlicense", 2, "domain", r"dedicate any and all copyright interest in the software to the public domain"),
    ("wtfpl", 2, "licen", r"everyone is permitted to copy and distribute verbatim or modified copies of this license document"),
    ("cc0", 2, "copyright", r"waived all copyright and related or neighbou?ring rights"),
    ("cc0", 2, "domain", r"creative ?commons org publicdomain zero"),
    ("cc-by", 2, "licen", r"creative ?commons org licenses by [1-4] [05]"),
    ("cc-by-sa", 2, "licen", r"creative ?commons org licenses by sa [1-4] [05]"),
    ("cc-by-nc", 2, "licen", r"creative ?commons org licenses by nc [1-4] [05]"),
    ("cc-by-nd", 2, "licen", r"creative ?commons org licenses by nd [1-4] [05]"),
    ("cc-by-nc-sa", 2, "licen", r"creative ?commons org licenses by nc sa [1-4] [05]"),
    ("cc-by-nc-nd", 2, "licen", r"creative ?commons org licenses by nc nd [1-4] [05]"),
    ("cc-by", 2, "licen", r"licensed under a creative commons attribution"),
    ("ofl", 2, "licen", r"this font software is licensed under the sil open font license"),
    ("artistic", 2, "redistribut", r"under the same terms as perl itself"),
    ("php", 2, "licen", r"this source file is subject to version 3 0?1? of the php license"),
    ("openssl", 2, "licen", r"this product includes software developed by the openssl project"),
    ("beerware", 2, "licen", r"if we meet some day and you think this stuff is worth it"),
    ("json", 2, "copyright", r"the software shall be used for good not evil"),
    ("ncsa", 2, "permission", r"to deal with the software without restriction"),
    ("ms-pl", 2, "licen", r"if you bring a patent claim against any contributor over patents"),
    ("public-domain", 3, "domain", r"(?:released|placed|dedicated|hereby placed) (?:in|into|to) the public domain"),
    ("public-domain", 4, "domain", r"(?:is|are|in the) public domain"),
    ("proprietary", 3, "licen", r"this software is licensed not sold"),
    ("proprietary", 3, "permission", r"may not be (?:copied|reproduced|distributed|disclosed) .{0,60}?without (?:the )?(?:prior |express )*written permission"),
    ("proprietary", 4, "copyright", r"all rights reserved"),
    ("proprietary", 4, "licen", r"end user license agreement"),
    ("proprietary", 4, "licen", r"unauthorized copying of this file"),
    # MIT, X11 and their kin.
    ("mit", 2, "licen", r"(?:released|available|distributed|licensed|published) under the (?:terms of the )?mit licen[sc]e"),
    ("mit", 2, "licen", r"opensource org licenses mit"),
    ("mit", 2, "copyright", r"in no event shall the authors or copyright holders be liable for any claim damages or other liability"),
    ("mit", 2, "warrant", r"the software is provided as is without warranty of any kind express or implied including but not limited to"),
    ("mit", 3, "licen", r"see (?:the )?licen[sc]e(?: file| txt| md)? for the full mit"),
    ("mit", 4, "licen", r"dual licensed under (?:the )?mit(?: and| or)?"),
    ("mit-0", 2, "permission", r"to permit persons to whom the software is furnished to do so the software is provided as is"),
    ("x11", 2, "permission", r"the name of the x consortium shall not be used in advertising or otherwise"),
    ("x11", 2, "copyright", r"except as contained in this notice the names? of .{1,80}? shall not be used in advertising"),
    ("isc", 2, "warrant", r"the author disclaims all warranties with regard to this software including all implied warranties"),
    ("0bsd", 2, "permission", r"permission to use copy modify and(?: or)? distribute this software for any purpose with or without fee is hereby granted the software is provided"),
    ("ntp", 2, "permission", r"provided that the above copyright notice appears in all copies .{0,200}? the name .{1,60}? not be used in advertising or publicity"),
    ("smlnj", 2, "licen", r"standard ml of new jersey copyright notice license and disclaimer"),
    ("hpnd", 2, "permission", r"makes no representations about the suitability of this software for any purpose"),
    ("unicode", 2, "permission", r"a copy of the unicode data files and any associated documentation"),
    ("unicode", 2, "copyright", r"unicode org copyright html"),
    ("icu", 2, "permission", r"provided that the above copyright notice s and this permission notice appear in all copies of the software"),
    ("curl", 2, "permission", r"provided that the above copyright notice and this permission notice appear in all copies the software is provided as is without warranty .{0,300}? third party rights"),
    ("vim", 2, "permission", r"vim is charityware"),
    ("mit-cmu", 2, "permission", r"the name of cmu and the regents of the university of california not be used in advertising"),
    # BSD and what follows it.
    ("bsd", 2, "licen", r"use of this source code is governed by a bsd style licen[sc]e"),
    ("bsd", 2, "licen", r"(?:released|available|distributed|licensed) under the (?:terms of the )?(?:[0-9a-z]+ )?bsd licen[sc]e"),
    ("bsd", 2, "redistribut", r"this list of conditions and the following disclaimer in the documentation and or other materials"),
    ("bsd", 2, "warrant", r"this software is provided by the copyright holders and contributors as is and any express or implied warranties"),
    ("bsd", 2, "copyright", r"in no event shall the (?:copyright (?:owner|holder)s?|regents|authors?) (?:or contributors )?be liable for any direct indirect incidental"),
    ("bsd", 2, "licen", r"opensource org licenses bsd license"),
    ("bsd-2-clause", 2, "licen", r"opensource org licenses bsd 2 clause"),
    ("bsd-3-clause", 2, "licen", r"opensource org licenses bsd 3 clause"),
    ("bsd-3-clause", 2, "permission", r"the name of the author may not be used to endorse or promote products derived from this software without"),
    ("bsd-3-clause", 2, "copyright", r"copyright (?:c )?.{0,40}?the regents of the university of california all rights reserved"),
    ("bsd-4-clause", 2, "redistribut", r"this product includes software developed by the university of california berkeley and its contributors"),
    ("bsd-patent", 2, "redistribut", r"each copyright holder and contributor hereby grants to each contributor a perpetual worldwide .{0,80}? patent license"),
    ("bsd-protection", 2, "licen", r"this is a protection license that requires that distributed derivative works"),
    ("sleepycat", 2, "redistribut", r"redistributions in any form must be accompanied by information on how to obtain complete source code"),
    ("openssl", 2, "redistribut", r"the names openssl toolkit and openssl project must not be used to endorse"),
    ("ssleay", 2, "copyright", r"this package is an ssl implementation written by eric young"),
    ("php", 2, "redistribut", r"this product includes php software freely available from"),
    ("postgresql", 2, "permission", r"permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement"),
    ("tcl", 2, "permission", r"the authors hereby grant permission to use copy modify distribute and license this software"),
    ("ncsa", 2, "redistribut", r"neither the names? of .{1,100}? nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("w3c", 2, "licen", r"by obtaining using and or copying this work you the licensee agree that you have read understood"),
    ("w3c", 2, "licen", r"w3 org consortium legal .{0,40}?copyright software"),
    # Apache.
    ("apache", 2, "licen", r"(?:released|available|distributed|published) under the (?:terms of the )?apache licen[sc]e"),
    ("apache", 2, "licen", r"see the notice file distributed with this work for additional information"),
    ("apache", 2, "licen", r"unless required by applicable law or agreed to in writing software distributed under the license"),
    ("apache", 2, "licen", r"opensource org licenses apache 2 0"),
    ("apache", 2, "licen", r"terms and conditions for use reproduction and distribution 1 definitions license shall mean"),
    ("apache", 2, "redistribut", r"the names? apache(?: server)?(?: group)? and apache software foundation must not be used"),
    ("apache", 2, "redistribut", r"this product includes software developed by the apache (?:software foundation|group)"),
    ("apache", 3, "licen", r"apache (?:software )?licen[sc]e and the mit licen[sc]e"),
    # GNU licenses.
    ("gpl", 2, "licen", r"(?:released|available|distributed|licensed|published) under the (?:terms of the )?(?:gnu )?gpl"),
    ("gpl", 2, "licen", r"this program is free software licensed under the terms of the gnu general public license"),
    ("gpl", 2, "warrant", r"this program is distributed in the hope that it will be useful but without any warranty"),
    ("gpl", 2, "warrant", r"without even the implied warranty of merchantability or fitness for a particular purpose see the gnu general public license"),
    ("gpl", 2, "licen", r"the licenses for most software are designed to take away your freedom to share and change it"),
    ("gpl", 2, "licen", r"the gnu general public license is a free copyleft license for software and other kinds of works"),
    ("gpl", 2, "licen", r"the gnu general public license is intended to guarantee your freedom to share"),
    ("gpl", 2, "gpl", r"may be distributed under the terms of the (?:gnu )?gpl"),
    ("gpl", 2, "gpl", r"free software foundation .{0,60}? gpl v(?:ersion )?[123]"),
    ("gpl", 2, "licen", r"alternatively this software may be distributed under the terms of the gnu general public license"),
    ("gpl", 3, "gpl", r"gpl ?v[123](?: or later)?"),
    ("gpl", 3, "licen", r"gnu general public license as published by the free software foundation"),
    ("gpl-classpath", 2, "permission", r"as a special exception the copyright holders of this library give you permission to link this library with independent modules"),
    ("gpl-gcc", 2, "permission", r"gcc runtime library exception"),
    ("gpl-bison", 2, "permission", r"as a special exception you may create a larger work that contains part or all of the bison parser skeleton"),
    ("gpl-autoconf", 2, "licen", r"as a special exception to the gnu general public license if you distribute this file as part of a program that contains a configuration script generated by autoconf"),
    ("gpl-openssl", 2, "permission", r"give(?:s)? permission to link the code of (?:this program|portions of this program) with the openssl library"),
    ("gpl-linux-syscall", 2, "copyright", r"this copyright does not cover user programs that use kernel services by normal system calls"),
    ("lgpl", 2, "warrant", r"this library is distributed in the hope that it will be useful but without any warranty"),
    ("lgpl", 2, "licen", r"the gnu lesser general public license incorporates the terms and conditions of version 3 of the gnu general public license"),
    ("lgpl", 2, "licen", r"(?:released|available|distributed|licensed) under the (?:terms of the )?(?:gnu )?lgpl"),
    ("lgpl", 2, "licen", r"gnu lesser general public license as published by the free software foundation"),
    ("lgpl", 3, "gpl", r"lgpl ?v(?:2|2 1|3)(?: or later)?"),
    ("agpl", 2, "licen", r"the gnu affero general public license is a free copyleft license for software and other kinds of works specifically designed to ensure cooperation"),
    ("agpl", 2, "licen", r"gnu affero general public license as published by the free software foundation"),
    ("agpl", 3, "gpl", r"agpl ?v3(?: or later)?"),
    ("gfdl", 2, "licen", r"with no invariant sections no front cover texts and no back cover texts"),
    ("gfdl", 2, "licen", r"the purpose of this license is to make a manual textbook or other functional and useful document free"),
    ("gnu-all-permissive", 2, "copyright", r"copying and distribution of this file with or without modification are permitted in any medium without royalty provided the copyright notice"),
    ("fsf-unlimited", 2, "permission", r"the free software foundation gives unlimited permission to copy distribute and modify it"),
    # Weaker copyleft.
    ("mpl", 2, "licen", r"mozilla org mpl (?:mpl )?[12] [01]"),
    ("mpl", 2, "licen", r"this source code form is incompatible with secondary licenses"),
    ("mpl", 2, "licen", r"software distributed under the license is distributed on an as is basis without warranty of any kind either express or implied see the license for the specific language governing rights"),
    ("npl", 2, "licen", r"subject to the netscape public license version 1 [01]"),
    ("epl", 2, "licen", r"the accompanying program is provided under the terms of this eclipse public license"),
    ("epl", 2, "licen", r"this program and the accompanying materials are made available under the terms of the eclipse public license"),
    ("cpl", 2, "licen", r"the accompanying program is provided under the terms of this common public license"),
    ("cddl", 2, "licen", r"you can obtain a copy of the license at .{0,60}? cddl"),
    ("cddl", 2, "licen", r"include this license header notice in each file and include the license file"),
    ("ms-rl", 2, "licen", r"for any file you distribute that contains code from the software .{0,60}? you must provide recipients the source code"),
    ("ms-pl", 2, "licen", r"this license governs use of the accompanying software if you use the software you accept this license"),
    ("osl", 2, "licen", r"licensed under the open software license version [123] 0"),
    ("afl", 2, "licen", r"licensed under the academic free license version [123] [012]"),
    ("apsl", 2, "licen", r"subject to the apple public source license version [12] [0-2]"),
    ("qpl", 2, "licen", r"may be distributed under the terms of the q public license as defined by trolltech"),
    ("cecill", 2, "licen", r"this software is governed by the cecill(?: [bc])? licen[sc]e under french law"),
    ("eupl", 2, "licen", r"licence for the european union public licence"),
    ("eupl", 2, "licen", r"unless required by applicable law or agreed to in writing software distributed under the licence is distributed on an as is basis"),
    ("artistic", 2, "licen", r"the intent of this document is to state the conditions under which a package may be copied"),
    ("artistic", 2, "copyright", r"the copyright holder maintains some semblance of artistic control"),
    ("artistic", 2, "licen", r"(?:gnu )?general public license or the artistic license"),
    ("latex", 2, "licen", r"this work may be distributed and or modified under the conditions of the latex project public license"),
    ("latex", 2, "licen", r"this work has the lppl maintenance status"),
    ("zope", 2, "licen", r"this software is subject to the provisions of the zope public license"),
    ("python", 2, "licen", r"psf is making python available to licensee on an as is basis"),
    ("python", 2, "licen", r"psf license agreement for python"),
    ("python", 2, "licen", r"cnri open source license agreement"),
    ("ruby", 2, "copyright", r"ruby is copyrighted free software by yukihiro matsumoto"),
    ("ruby", 2, "redistribut", r"you may make and give away verbatim copies of the source form of the software without restriction"),
    ("perl", 2, "redistribut", r"this (?:library|module|program) is free software you (?:can|may) redistribute it and or modify it under the same terms as perl"),
    # Data, media and fonts.
    ("cc0", 2, "copyright", r"to the extent possible under law .{1,80}? has waived all copyright"),
    ("cc0", 2, "domain", r"cc0 1 0 universal(?: public domain dedication)?"),
    ("cc-by", 2, "licen", r"this work is licensed under (?:a|the) (?:creative commons|cc) (?:by|attribution) [1-4] [05]"),
    ("cc-by-sa", 2, "licen", r"this work is licensed under (?:a|the) creative commons attribution share ?alike"),
    ("cc-by-sa", 2, "licen", r"text is available under the creative commons attribution share ?alike license"),
    ("cc-by-nc", 2, "licen", r"this work is licensed under (?:a|the) creative commons attribution non ?commercial [1-4] [05]"),
    ("cc-by-nd", 2, "licen", r"this work is licensed under (?:a|the) creative commons attribution no ?deriv"),
    ("odbl", 2, "licen", r"made available under the open database license"),
    ("odbl", 2, "licen", r"opendatacommons org licenses odbl"),
    ("odc-by", 2, "licen", r"opendatacommons org licenses by"),
    ("pddl", 2, "licen", r"opendatacommons org licenses pddl"),
    ("osm", 2, "copyright", r"openstreetmap(?: org)? (?:contributors|copyright)"),
    ("ogl", 2, "licen", r"contains public sector information licensed under the open government licen[sc]e"),
    ("ofl", 2, "licen", r"the goals of the open font license ofl are to stimulate worldwide development of collaborative font projects"),
    ("ofl", 2, "copyright", r"with reserved font name"),
    ("bitstream-vera", 2, "licen", r"obtaining a copy of the fonts accompanying this license fonts and associated documentation files"),
    ("ubuntu-font", 2, "licen", r"ubuntu font licen[sc]e"),
    ("fal", 2, "licen", r"free art licen[sc]e|copyleft attitude"),
    ("design-science", 2, "licen", r"design science license"),
    ("ogl-game", 2, "licen", r"open game license version 1 0a?"),
    # Public domain.
    ("public-domain", 2, "domain", r"(?:the )?authors? disclaims? copyright to this source code"),
    ("public-domain", 2, "copyright", r"this file has been put into the public domain|no copyright is claimed"),
    ("public-domain", 2, "domain", r"i hereby (?:place|release|put) (?:this|it) .{0,40}?(?:in|into) the public domain"),
    ("public-domain", 2, "copyright", r"not subject to copyright protection and is in the public domain"),
    ("public-domain", 2, "copyright", r"pursuant to title 17 section 105 of the united states code"),
    ("public-domain", 3, "domain", r"public domain (?:work|software|mark|dedication)"),
    # Source that is not free, and terms of use.
    ("busl", 2, "licen", r"the licensor hereby grants you the right to copy modify create derivative works redistribute and make non production use"),
    ("busl", 2, "licen", r"change date .{0,80}? change licen[sc]e"),
    ("sspl", 2, "licen", r"if you make the functionality of the program or a modified version available to third parties as a service"),
    ("elastic", 2, "licen", r"you may not provide the software to third parties as a hosted or managed service"),
    ("commons-clause", 2, "licen", r"commons clause (?:license )?condition"),
    ("polyform", 2, "licen", r"polyformproject org licenses"),
    ("confluent", 2, "licen", r"confluent community licen[sc]e"),
    ("openrail", 2, "licen", r"use based restrictions as referenced in paragraph 5"),
    ("llama", 2, "licen", r"llama [0-9 ]{0,4}community licen[sc]e"),
    ("gemma", 2, "licen", r"gemma terms of use"),
    ("jrl", 2, "licen", r"java research license"),
    ("bcl", 2, "licen", r"binary code license agreement"),
    ("oracle-otn", 2, "licen", r"oracle technology network (?:developer )?license"),
    ("cuda", 2, "licen", r"nvidia (?:cuda|software) (?:toolkit )?(?:end user )?license agreement"),
    ("intel-bin", 2, "redistribut", r"no reverse engineering decompilation or disassembly of this software is permitted"),
    ("shareware", 3, "licen", r"this (?:software|program) is shareware"),
    ("freeware", 3, "licen", r"this (?:software|program) is freeware"),
    ("evaluation", 3, "licen", r"for (?:evaluation|trial) (?:purposes|use) only"),
    ("non-commercial", 3, "permission", r"(?:free )?for (?:personal|academic|educational|research|non ?commercial)(?: and (?:personal|academic|educational|research|non ?commercial))? (?:use|purposes) only"),
    ("no-derivatives", 3, "permission", r"no derivative works? (?:is|are) (?:permitted|allowed)"),
    ("proprietary", 3, "copyright", r"this (?:software|document|file|material) (?:is|contains) (?:the )?(?:proprietary|confidential)(?: and (?:proprietary|confidential))? (?:property|information)"),
    ("proprietary", 3, "copyright", r"trade secrets? .{0,80}? protected by copyright"),
    ("proprietary", 3, "redistribut", r"redistribution (?:of this .{0,30}? )?is (?:strictly )?(?:prohibited|forbidden|not permitted)"),
    ("proprietary", 3, "licen", r"subject to the terms of (?:a|an|your) (?:commercial|separate|signed) licen[sc]e agreement"),
    ("proprietary", 4, "permission", r"reproduced with (?:the )?(?:kind )?permission(?: of)?"),
    ("proprietary", 4, "permission", r"without (?:the )?(?:prior |express )+(?:written )?permission"),
    ("copyright", 5, "copyright", r"portions? copyright"),
    ("copyright", 5, "copyright", r"no part of this (?:publication|work|document|book)"),
    ("license", 5, "licen", r"for (?:more )?licen[sc](?:e|ing) (?:information|details|terms)"),
    ("license", 5, "licen", r"third party licen[sc]es?|open source licen[sc]es?"),
    ("warranty", 5, "warrant", r"(?:without|no) (?:any )?(?:express |implied )?warranty"),
    ("copyright", 5, "copyright", r"copyright (?:c )?(?:19|20)[0-9]{2}"),
    ("copyright", 5, "copyright", r"copyright (?:c|holders?|owners?|notice)"),
    ("license", 5, "licen", r"licen[sc]ed? under(?: the)?(?: terms of)?"),
    ("license", 5, "licen", r"terms of (?:the|this) licen[sc]e"),
    ("license", 5, "licen", r"see (?:the )?(?:file )?(?:licen[sc]e|copying)(?: file| txt)?"),
    ("license", 5, "spdx", r"spdx license identifier"),
    ("copyleft", 5, "copyleft", r"copyleft"),
]


def _pattern(words: str) -> str:
    """Whole words, with any characters that are no letters or digits between them."""
    return r"(?<![a-z0-9])(?:" + words.replace(" ?", "\0").replace(" ", "[^a-z0-9]+").replace("\0", "[^a-z0-9]?") + r")(?![a-z0-9])"


def _keyword(name: str) -> str:
    """The longest word that each match of the name holds."""
    return max(re.findall(r"[a-z0-9]+", re.sub(r"\(\?:.*?\)\??|\w\?", " ", name)), key=len)


def rules() -> list[tuple[int, str, int, str, str]]:
    """(rank, label, tier, keyword, pattern) of all rules, in their order of priority."""
    out = []
    for label, tags, names in FAMILIES:
        for tag in tags:
            out.append((label, 1, "spdx", r"spdx-license-identifier:\s*\(?(?:[a-z0-9.+-]+\s+(?:or|and)\s+)?" + tag + r"(?![a-z0-9.+-])"))
        for name in names:
            out.append((label, 3, _keyword(name), _pattern(name + r" licen[sc]e(?: agreement)? (?:v|version )?[0-9]+(?: [0-9]+)?")))
            out.append((label, 4, _keyword(name), _pattern(name + r" licen[sc]es?")))
    out += [(label, tier, keyword, _pattern(words)) for label, tier, keyword, words in NOTICES]
    out.sort(key=lambda rule: rule[1])
    return [(rank, *rule) for rank, rule in enumerate(out)]


def alternations() -> dict[str, str]:
    """By keyword with many rules, one pattern that finds what any of them finds."""
    found: dict[str, list[str]] = {}
    for _, _, _, keyword, pattern in rules():
        found.setdefault(keyword, []).append(pattern)
    return {keyword: "|".join(dict.fromkeys(patterns)) for keyword, patterns in found.items() if len(patterns) > 4}
